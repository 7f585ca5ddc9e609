"""Line dedup: range-partitioned line hashes, streamed in order, answered as bitmaps.

1. Each document is split at ``\\n`` in one pass over the text, which emits one narrow row
   per line: the 128-bit hash of its key, the document's row key, and the position.
2. Rows are range-partitioned by (hash, document) and sorted by (hash, document,
   position). A hash that a third of all lines share spans many partitions; a document's
   lines of one hash stay together, so documents are counted without a set.
3. Each partition is streamed once, run by run. A run reaching `min_docs` documents is
   known to be dropped and passes through; until then at most `min_docs - 1` documents'
   rows wait. Only the first and last run of a partition can continue in another; if they
   are undecided they are put aside with their counts (at most two per partition) and
   settled by a join of that size.
4. Dropped positions return per document as one zlib-compressed keep bitmap, never as
   text; documents take their bitmap in one join on the row key and drop their lines.

Defined cases: a null or empty text is one empty line; keys shorter than `min_chars` code
points are never dropped; fully repeated rows (same id and text) count as one document and
each get the same result; ids may be null; columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwise.llm.common import KEY, stage, texts, with_row_key

SPACE = b" \t\n\x0b\x0c\r"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

LINES = "h1 long, h2 long, _k1 long, _k2 long, pos int"
DROPS = f"kind int, {LINES}, n_docs long"


def line_key(line: bytes) -> bytes:
    """Stripped of ASCII white space, A-Z lower-cased."""
    return line.strip(SPACE).translate(LOWER)


def _chars(key: bytes) -> int:
    return len(key) - sum(1 for b in key if 0x80 <= b < 0xC0) if not key.isascii() else len(key)


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key may be dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in KEY)
            digests, rows, pos = [], [], []
            for i, text in enumerate(texts(batch)):
                for p, line in enumerate(text.split(b"\n")):
                    key = line_key(line)
                    if len(key) >= min_chars and (min_chars <= 1 or _chars(key) >= min_chars):
                        digests.append(xxhash.xxh3_128_digest(key))
                        rows.append(i)
                        pos.append(p)
            h = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            rows = np.array(rows, dtype=np.int64)
            cols = [h[:, 0], h[:, 1], k1[rows], k2[rows], np.array(pos, dtype=np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], ["h1", "h2", *KEY, "pos"])

    return docs.select(*KEY, "text").mapInArrow(run, LINES)


def _batch(kind: int, cols: list[np.ndarray], n_docs: int = 0) -> pa.RecordBatch:
    n = len(cols[0])
    arrays = [np.full(n, kind, np.int32), *cols, np.full(n, n_docs, np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(a)) for a in arrays], ["kind", "h1", "h2", *KEY, "pos", "n_docs"])


class _OpenRun:
    """The run of equal hashes that the last batch ended in.

    Emits rows of kind 0 (line to drop), 1 (line of an undecided run at a partition's edge)
    and 2 (documents of such an edge run).
    """

    def __init__(self, min_docs: int) -> None:
        self.min_docs, self.key, self.last = min_docs, None, None
        self.docs, self.held, self.first = 0, [], True

    def close(self, at_end: bool) -> Iterator[pa.RecordBatch]:
        if self.key is None:
            return
        if self.first or at_end:
            ints = [np.array([v], np.int64) for v in (*self.key, 0, 0)]
            yield _batch(2, [*ints, np.zeros(1, np.int32)], self.docs)
            if self.held:
                yield _batch(1, [np.concatenate(c) for c in zip(*self.held, strict=True)])
        self.first = False

    def open(self, key: tuple[int, int]) -> None:
        self.key, self.docs, self.held = key, 0, []

    def add(self, cols: list[np.ndarray], a: int, b: int, n: int, drop: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.docs += n
        drop[a:b] = self.docs >= self.min_docs
        if self.docs < self.min_docs:
            self.held.append([c[a:b] for c in cols])
        elif self.held:
            yield _batch(0, [np.concatenate(c) for c in zip(*self.held, strict=True)])
            self.held = []


def _stream(min_docs: int):
    """Walks one sorted partition; see the module's step 3."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _OpenRun(min_docs)
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", *KEY, "pos")]
            h1, h2, k1, k2, _ = cols
            new_run = np.concatenate([[(h1[0], h2[0]) != state.key], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
            new_doc = new_run | np.concatenate([[(k1[0], k2[0]) != state.last], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
            starts = np.union1d([0], np.flatnonzero(new_run)).astype(np.int64)
            ends = np.append(starts[1:], len(h1))
            counts = np.add.reduceat(new_doc.astype(np.int64), starts)
            # Runs that begin and end inside the batch are whole; the outer two are not.
            drop = np.repeat(counts >= min_docs, ends - starts)
            for j in sorted({0, len(starts) - 1}):
                a, b = int(starts[j]), int(ends[j])
                if new_run[a]:
                    yield from state.close(False)
                    state.open((int(h1[a]), int(h2[a])))
                yield from state.add(cols, a, b, int(counts[j]), drop)
            state.last = (int(k1[-1]), int(k2[-1]))
            if drop.any():
                yield _batch(0, [c[drop] for c in cols])
        yield from state.close(True)

    return run


def bitmaps(drops: DataFrame) -> DataFrame:
    """`(_k1, _k2, keep)`: zlib-compressed bits, one per line up to the last dropped one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for pos in batch.column("pos"):
                p = np.array(pos.as_py(), dtype=np.int64)
                keep = np.ones((int(p.max()) // 8 + 1) * 8, bool)  # whole bytes; the rest is kept
                keep[p] = False
                out.append(zlib.compress(np.packbits(keep).tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(KEY[0]), batch.column(KEY[1]), pa.array(out, pa.binary())], [*KEY, "keep"])

    return drops.groupBy(*KEY).agg(F.collect_list("pos").alias("pos")).mapInArrow(run, "_k1 long, _k2 long, keep binary")


def keep_bitmaps(keyed: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Keep bitmaps of the documents (with row keys) that lose at least one line."""
    spark = keyed.sparkSession
    lines = stage(line_hashes(keyed, min_chars), "line-hashes")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = lines.repartitionByRange(n, "h1", "h2", *KEY).sortWithinPartitions("h1", "h2", *KEY, "pos")
    found = stage(ordered.mapInArrow(_stream(min_docs), DROPS), "line-drops")
    # Runs at partition edges: at most two counts and 2 * min_docs documents a partition.
    over = found.where("kind = 2").groupBy("h1", "h2").agg(F.sum("n_docs").alias("n")).where(F.col("n") >= min_docs)
    edge = found.where("kind = 1").join(over, ["h1", "h2"], "left_semi")
    drops = found.where("kind = 0").select(*KEY, "pos").union(edge.select(*KEY, "pos"))
    return bitmaps(drops)


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id") -> DataFrame:
    """Documents without the lines whose key occurs in at least `min_docs` documents.

    Returns the id, `text` (what is kept), `n_lines`, `n_dropped` and the keep bitmap `keep`
    (null: every line stays).
    """
    keyed = with_row_key(docs.select(F.col(id_col).alias("_id"), "text"), "_id", "text")
    joined = keyed.join(keep_bitmaps(keyed, min_docs, min_chars), list(KEY), "left")
    id_type = keyed.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            for text, keep in zip(texts(batch), batch.column("keep"), strict=True):
                lines = text.split(b"\n")
                total = len(lines)
                if keep.is_valid:
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep.as_py()), np.uint8)).astype(bool)
                    bits = np.concatenate([bits[:total], np.ones(max(0, total - len(bits)), bool)])
                    lines = [x for x, b in zip(lines, bits, strict=True) if b]
                kept.append(b"\n".join(lines))
                n_lines.append(total)
                n_dropped.append(total - len(lines))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), batch.column("keep")],
                [id_col, "text", "n_lines", "n_dropped", "keep"],
            )

    return joined.select("_id", "text", "keep").mapInArrow(run, f"`{id_col}` {id_type}, text string, n_lines long, n_dropped long, keep binary")


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns."""
    return drop_common_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )
