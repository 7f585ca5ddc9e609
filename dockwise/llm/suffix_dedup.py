"""Suffix-array dedup: repeated byte windows by a depth-limited radix sort.

A byte is removed if a window of `window` bytes covering it also starts elsewhere. Suffixes
are ordered only through the window length, in passes from the most significant digit on;
after each pass a suffix whose group has one member is settled (its window is unique), and
groups that are still equal after the last pass are exactly the repeated windows.

To keep the passes narrow, windows that must fall together are carried as one row:

* Pass 0. The digit is the window's anchor: its `GRAM`-byte substring of smallest hash (the
  leftmost one). Equal windows have equal anchors at equal offsets, and the windows sharing
  an anchor are neighbours, so one row stands for about `window / 2` suffixes. Rows whose
  whole block (the union of their windows) is equal are repeated throughout; rows whose
  anchor occurs once are unique throughout. Copies, however many, are settled here by
  counting.
* Passes 1 and 2. The rest (blocks at the edge of a copy) is split into cells of 96, then
  12 neighbouring windows. The digit is the part that all windows of a cell contain. Cells
  alone with it are unique; cells equal as a whole are repeated.
* Pass 3. The last digit is the window itself, for cells still undecided.

Every pass counts equal digits with a map-side aggregate; no group is gathered. Digits are
64-bit substring hashes within groups that already agree on 64 bits of the anchor, of a hash
of another kind.
Documents' bytes are read for the anchors, joined once to cut out the undecided blocks
(settled blocks need one representative), and joined once more to remove what repeats.

Defined cases: a null text is empty; texts shorter than the window keep all bytes; fully
repeated rows (same id and text) are separate documents whose windows repeat each other;
ids may be null; other columns are not read. Kept bytes need not be valid UTF-8, so they
are returned as binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwise.llm.common import KEY, attach_group_facts, discard, stage, texts, with_row_key

GRAM = 32
CELLS = (96, 12, 1)
PIECE = 1 << 20  # bytes hashed at a time
MASK = (1 << 64) - 1


def _inverse(x: int) -> int:
    """Inverse of an odd number modulo 2**64."""
    y = x
    for _ in range(6):
        y = y * (2 - x * y) & MASK
    return y


_RNG = np.random.default_rng(77)
BASE = int(_RNG.integers(1 << 60, 1 << 62)) | 1
TABLE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class Hasher:
    """Hashes of any substring of a piece of bytes, from one running sum."""

    def __init__(self, size: int = 1 << 12) -> None:
        self.size = 0
        self._grow(size)

    def _grow(self, size: int) -> None:
        if size > self.size:
            self.size = 1 << (size - 1).bit_length()
            self.up, self.down = _powers(BASE, self.size), _powers(_inverse(BASE), self.size)

    def load(self, data: np.ndarray) -> None:
        self._grow(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(TABLE[data] * self.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])


def gram_hash(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the `GRAM` bytes at each place, by mixing words of eight bytes one after the other:
    of another kind than the substring hashes, with which it shares no collisions."""
    grams = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, GRAM)[at]).view(np.uint64)
    h = np.full(len(at), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(grams.shape[1]):
        h = _mix(_mix(grams[:, k] ^ h) * np.uint64(0xC2B2AE3D27D4EB4F) + h)
    return h


def anchors(hasher: Hasher, n: int, window: int) -> np.ndarray:
    """The anchor of the window at each start, windows running over the whole piece."""
    span = window - GRAM + 1
    grams = n - GRAM + 1
    at = np.arange(grams)
    # Hash in the high bits, position in the low ones: the minimum is the leftmost smallest.
    key = (hasher.of(at, at + GRAM) & np.uint64(MASK ^ ((1 << 24) - 1))) | at.astype(np.uint64)
    rows = -(-grams // span)
    padded = np.full(rows * span, MASK, np.uint64)
    padded[:grams] = key
    grid = padded.reshape(rows, span)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts = n - window + 1
    least = np.minimum(behind[:starts], ahead[span - 1 : span - 1 + starts])
    return (least & np.uint64((1 << 24) - 1)).astype(np.int64)


def _pieces(batch: pa.RecordBatch, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Whole documents packed into pieces; a longer document is cut with overlap.

    Yields the bytes, and per part of a document its row, its place in the piece, its length
    and its first byte's place in the document. Each window lies in exactly one part.
    """
    parts: list[tuple[int, bytes, int]] = []
    held = 0
    for row, text in enumerate(texts(batch)):
        for a in range(0, max(1, len(text) - window + 1), PIECE):
            part = text[a : a + PIECE + window - 1] if len(text) > PIECE else text
            if len(part) < window:
                continue
            if held and held + len(part) > PIECE:
                yield _pack(parts)
                parts, held = [], 0
            parts.append((row, part, a))
            held += len(part)
    if parts:
        yield _pack(parts)


def _pack(parts: list[tuple[int, bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(p[1]) for p in parts], np.int64)
    data = np.frombuffer(b"".join(p[1] for p in parts), np.uint8)
    return data, np.array([p[0] for p in parts], np.int64), np.cumsum(size) - size, size, np.array([p[2] for p in parts], np.int64)


def anchor_rows(docs: DataFrame, window: int) -> DataFrame:
    """One row per anchor: `kg` its hash, `block` the hash of the union of its windows, the
    document's key, and `pos`: first start, number of further starts and anchor offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy() for c in KEY)
            for data, rows, place, size, first in _pieces(batch, window):
                hasher.load(data)
                anchor = anchors(hasher, len(data), window)
                # Starts whose window ends in their own part.
                ends = np.zeros(len(data) + 1, np.int64)
                ends[place] += 1
                ends[place + size - window + 1] -= 1
                start = np.flatnonzero(np.cumsum(ends)[: len(anchor)])
                anchor = anchor[start]
                new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)])
                lo = start[new]
                hi = start[np.append(np.flatnonzero(new)[1:], len(start)) - 1]
                a = anchor[new]
                part = np.searchsorted(place, lo, "right") - 1
                doc_lo = lo - place[part] + first[part]
                cols = [
                    gram_hash(data, a).view(np.int64),
                    hasher.of(lo, hi + window).view(np.int64),
                    k1[rows[part]],
                    k2[rows[part]],
                    doc_lo << 20 | (hi - lo) << 10 | (a - lo),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["kg", "block", *KEY, "pos"])

    return docs.select(*KEY, "text").mapInArrow(run, "kg long, block long, _k1 long, _k2 long, pos long")


def _rid(*cols: str) -> F.Column:
    return F.xxhash64(*cols)


def settle_blocks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pass 0: rows repeated throughout, and rows to look into (`weight` 2 stands for a
    block known to be repeated, of which one representative is kept)."""
    blocks = stage(
        rows.groupBy("kg", "block").agg(F.count(F.lit(1)).alias("n"), F.min(_rid(*KEY, "pos")).alias("rep")), "suffix-blocks"
    )
    mixed = stage(
        blocks.groupBy("kg").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).where("m > 1 AND least = 1").select("kg", "m"),
        "suffix-mixed",
    )
    facts = stage(
        attach_group_facts(blocks, mixed, ["kg"], "m", "block").where("n > 1 OR m IS NOT NULL"), "suffix-block-facts"
    )
    known = stage(attach_group_facts(rows, facts, ["kg", "block"], "n", "pos").where("n IS NOT NULL"), "suffix-known")
    discard(blocks, mixed, facts)
    look = known.where(F.col("m").isNotNull() & ((F.col("n") == 1) | (F.col("rep") == _rid(*KEY, "pos"))))
    weight = F.when(F.col("n") == 1, 1).otherwise(2)
    return known.where("n > 1").select(*KEY, "pos"), look.select(*KEY, "kg", "pos", weight.alias("weight")).distinct()


def cut_blocks(keyed: DataFrame, look: DataFrame, window: int) -> DataFrame:
    """The bytes of the blocks to look into: one text join on the row key.

    `start` is the first window's place in the document, `high` and `low` the largest and
    smallest offset of the anchor in the block's windows.
    """
    asked = look.groupBy(*KEY).agg(F.collect_list(F.struct("kg", "pos", "weight")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kg", *KEY, "start", "high", "low", "weight", "body"]
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            held = 0
            for k1, k2, text, wanted in zip(batch.column(KEY[0]).to_pylist(), batch.column(KEY[1]).to_pylist(), texts(batch), batch.column("asked"), strict=True):
                for x in wanted.as_py():
                    start, more, high = x["pos"] >> 20, x["pos"] >> 10 & 1023, x["pos"] & 1023
                    row = (x["kg"], k1, k2, start, high, high - more, x["weight"], text[start : start + more + window])
                    for c, v in zip(cols, row, strict=True):
                        c.append(v)
                    held += more + window
                if held > 8 << 20:
                    yield _block_batch(names, cols)
                    cols, held = [[] for _ in names], 0
            if cols[0]:
                yield _block_batch(names, cols)

    return keyed.join(asked, list(KEY)).select(*KEY, "text", "asked").mapInArrow(run, WORK)


WORK = "kg long, _k1 long, _k2 long, start long, high int, low int, weight int, body binary"
DIGITS = "kg long, digit long, whole long, _k1 long, _k2 long, start long, high int, low int, weight int"
_TYPES = {"high": pa.int32(), "low": pa.int32(), "weight": pa.int32(), "body": pa.binary()}


def _block_batch(names: list[str], cols: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES.get(n, pa.int64())) for n, c in zip(names, cols, strict=True)], names)


def _slices(batch: pa.RecordBatch, rows: int = 2000) -> Iterator[pa.RecordBatch]:
    for a in range(0, batch.num_rows, rows):
        yield batch.slice(a, rows)


def digit_rows(work: DataFrame, cell: int, window: int) -> DataFrame:
    """Rows of a pass: the cells of each block, their digit and the hash of their union.

    Cell boundaries are at multiples of `cell` from the anchor, so equal windows fall in
    equal cells. The digit is what every window of the full cell contains, whether or not
    the block holds all of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for whole in batches:
            for batch in _slices(whole):
                bodies = [b.as_buffer() for b in batch.column("body")]
                size = np.array([b.size for b in bodies], np.int64)
                place = np.cumsum(size) - size
                hasher.load(np.frombuffer(b"".join(bodies), np.uint8))
                kg, k1, k2, start, high, low, weight = (batch.column(c).to_numpy().astype(np.int64) for c in ("kg", *KEY, "start", "high", "low", "weight"))
                count = high // cell - low // cell + 1
                row = np.repeat(np.arange(len(count)), count)
                number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + (low // cell)[row]
                hi, lo = np.minimum(high[row], number * cell + cell - 1), np.maximum(low[row], number * cell)
                anchor = place[row] + high[row]
                digit = hasher.of(anchor - number * cell, anchor + window - (number * cell + cell - 1))
                union = hasher.of(anchor - hi, anchor - lo + window)
                # The cell is part of the digit, the cell's extent part of the union.
                digit = _mix(digit + number.astype(np.uint64) * np.uint64(BASE)).view(np.int64)
                union = _mix(union + (hi * 1024 + lo).astype(np.uint64) * np.uint64(BASE)).view(np.int64)
                cols = [kg[row], digit, union, k1[row], k2[row], start[row] + high[row] - hi, hi.astype(np.int32), lo.astype(np.int32), weight[row].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["kg", "digit", "whole", *KEY, "start", "high", "low", "weight"])

    return work.mapInArrow(run, DIGITS)


def run_pass(work: DataFrame, cell: int, window: int) -> tuple[DataFrame, DataFrame]:
    """One pass: the starts found repeated `(_k1, _k2, lo, hi)`, and the cells to go on with."""
    rows = stage(digit_rows(work, cell, window), "suffix-digits")
    unions = stage(
        rows.groupBy("kg", "digit", "whole").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"), F.min(_rid(*KEY, "start")).alias("rep")),
        "suffix-unions",
    )
    digits = stage(
        unions.groupBy("kg", "digit").agg(F.count(F.lit(1)).alias("m"), F.sum("w").alias("dw"), F.min("w").alias("least")).where("dw > 1"),
        "suffix-digit-counts",
    )
    facts = stage(
        attach_group_facts(unions, digits, ["kg", "digit"], "m", "whole").where("dw IS NOT NULL"), "suffix-union-facts"
    )
    known = stage(attach_group_facts(rows, facts, ["kg", "digit", "whole"], "n", "start").where("dw IS NOT NULL"), "suffix-known")
    discard(rows, unions, digits, facts)
    found = known.where("weight = 1 AND w > 1").select(*KEY, F.col("start").alias("lo"), (F.col("start") + F.col("high") - F.col("low")).alias("hi"))
    # Cells of weight one in a group of several, and one of each repeated union beside them.
    go_on = known.where((F.col("w") == 1) | ((F.col("least") == 1) & (F.col("rep") == _rid(*KEY, "start"))))
    weight = F.when(F.col("w") == 1, 1).otherwise(2)
    return found, go_on.select(*KEY, "start", "high", "low", weight.alias("weight")).distinct()


def narrow_work(work: DataFrame, go_on: DataFrame, window: int) -> DataFrame:
    """The bytes of the cells to go on with, cut from the blocks that hold them."""
    cells = go_on.withColumnsRenamed({"start": "s", "high": "h", "low": "l", "weight": "w"}).withColumn("anchor", F.col("s") + F.col("h"))
    blocks = work.withColumn("anchor", F.col("start") + F.col("high"))
    # A block is found by its document and anchor; of several cells of an anchor, by extent.
    both = blocks.join(cells, [*KEY, "anchor"]).where("h <= high AND l >= low")
    body = F.expr(f"substring(body, int(s - start) + 1, h - l + {window})")
    return both.select("kg", *KEY, F.col("s").alias("start"), F.col("h").alias("high"), F.col("l").alias("low"), F.col("w").alias("weight"), body.alias("body"))


def repeated_starts(keyed: DataFrame, window: int) -> DataFrame:
    """`(_k1, _k2, lo, hi)`: windows starting from `lo` to `hi` of the document repeat."""
    rows = stage(anchor_rows(keyed, window), "suffix-anchors")
    whole, look = settle_blocks(rows)
    discard(rows)
    lo = F.shiftright("pos", 20)
    out = whole.select(*KEY, lo.alias("lo"), (lo + F.shiftright("pos", 10).bitwiseAND(F.lit(1023))).alias("hi"))
    work = stage(cut_blocks(keyed, look, window), "suffix-work")
    # A cell's windows must have most of their bytes in common.
    for cell in (c for c in CELLS if c == 1 or c <= window // 4):
        found, go_on = run_pass(work, cell, window)
        out = out.union(found)
        if cell > 1:
            smaller = stage(narrow_work(work, go_on, window), "suffix-work")
            discard(work)
            work = smaller
    return out


def remove_repeats(docs: DataFrame, window: int = 400, id_col: str = "doc_id") -> DataFrame:
    """Documents without the bytes that a repeated window covers.

    Returns the id, `kept` (binary), `n_bytes`, `n_removed` and `removed`, the maximal
    removed byte ranges (end exclusive). `window` is from `GRAM` to `GRAM` + 1,023 bytes.
    """
    if not GRAM <= window < GRAM + 1024:
        raise ValueError(f"a window has from {GRAM} to {GRAM + 1023} bytes, not {window}")
    keyed = with_row_key(docs.select(F.col(id_col).alias("_id"), "text"), "_id", "text")
    ranges = repeated_starts(keyed, window).distinct().groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("starts"))
    id_type = keyed.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            kept, total, gone, removed = [], [], [], []
            for text, starts in zip(texts(batch), batch.column("starts"), strict=True):
                spans: list[list[int]] = []
                for x in starts.as_py() or []:
                    if spans and x["lo"] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], x["hi"] + window)
                    else:
                        spans.append([x["lo"], x["hi"] + window])
                edges = [0, *(p for s in spans for p in s), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                total.append(len(text))
                gone.append(len(text) - len(kept[-1]))
                removed.append([{"start": a, "end": b} for a, b in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(kept, pa.binary()), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(removed, spans_type)],
                [id_col, "kept", "n_bytes", "n_removed", "removed"],
            )

    joined = keyed.join(ranges, list(KEY), "left").select("_id", "text", "starts")
    return joined.mapInArrow(run, f"`{id_col}` {id_type}, kept binary, n_bytes long, n_removed long, removed array<struct<start:long,end:long>>")


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns."""
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
