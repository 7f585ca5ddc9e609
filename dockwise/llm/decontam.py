"""Benchmark decontamination with suffix arrays over the training documents.

Words are looked up in the benchmark's vocabulary; any other word ends a match. Documents
are taken in shards of about `shard_words` words, in the task that read them: nothing is
shuffled. Each shard gets a suffix array, and every suffix of every benchmark item is
binary-searched in it.

The arrays are sparse and depth-limited, both without loss. A suffix is kept only if a chain
of benchmark word pairs of the needed length starts at it: other suffixes cannot match a
window. Order beyond the window length is never used, because a longer match is a run of
window matches at the same distance between document and item. Equal benchmark suffixes are
searched once, and a place of a document is listed once for each size of window, so the work
is linear in the words on both sides, however often they repeat. For each item that shares a
window with a document, the longest verbatim match and its places on both sides are kept
(of several, the first in the item, then in the document).

The benchmark is the query set. It is cut by item into blocks of at most `block_bytes` of
text; one block is broadcast at a time and each document keeps a bitmap of the words hit
so far, so memory is bounded however large the benchmark is.

Defined cases: a null or blank text has no words and no hits; an item without words has no
window; an item shorter than `window` words is one window; repeated items each count, and
items with the same id count once; repeated rows and null ids are kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwise.llm.common import texts, tidy

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# UTF-8 bytes of the word characters: digits, a-z, and every byte of a non-ASCII code point.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BITS = 22
ARRAY = 1 << 20  # suffixes of one array

MATCHES = "array<struct<item_id:string, item_word:int, doc_word:int, n_words:int>>"


def words(text: bytes) -> list[bytes]:
    return WORD.findall(text.translate(LOWER))


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        return 0


class TestSuffixes:
    """The suffixes of a block of items, cut at the window length.

    Equal ones are one window: `low` holds the distinct windows in order, and the items of
    window `g` are the rows `first[g]` to `first[g + 1]` of `item`, `place` (its first place
    there) and `times`. Window numbers of item `i` in reading order are `window_of[edges[i]:edges[i + 1]]`.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        self.window = window
        self.vocabulary = _Vocabulary()
        number = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.items, tables = [], [np.zeros((0, window), np.int32)]
        pairs = [np.zeros((0, 2), np.int32)]
        for item_id, text in items:
            ids = np.array([number(w) for w in words(text)], np.int32)
            if not len(ids):
                continue
            short = max(window - len(ids), 0)
            tables.append(np.lib.stride_tricks.sliding_window_view(np.pad(ids, (0, short)), window))
            pairs.append(np.stack([ids[:-1], ids[1:]], axis=1))
            self.items.append(item_id)
        counts = np.array([len(t) for t in tables[1:]], np.int64)
        self.edges = np.concatenate([[0], np.cumsum(counts)])
        self.low, one, self.window_of = np.unique(_keys(np.concatenate(tables)), return_index=True, return_inverse=True)
        table = np.concatenate(tables)[one]
        self.size = np.count_nonzero(table, axis=1)
        self.shortest = int(self.size.min()) if len(table) else 0
        # Upper end of a prefix search: everything behind a short window.
        self.high = _keys(np.where(np.arange(window) >= self.size[:, None], np.iinfo(np.int32).max, table))
        owner = np.repeat(np.arange(len(counts)), counts)
        held, at, self.times = np.unique(self.window_of * max(len(counts), 1) + owner, return_index=True, return_counts=True)
        self.item, self.place = owner[at], at - self.edges[owner[at]]
        self.first = np.searchsorted(held, np.arange(len(table) + 1) * max(len(counts), 1))
        linked = np.concatenate(pairs)
        self.pairs = np.zeros(1 << BITS, bool)
        self.pairs[_mix(linked[:, 0], linked[:, 1])] = True

    def ids(self, text: bytes) -> np.ndarray:
        found = words(text)
        return np.fromiter(map(self.vocabulary.__getitem__, found), np.int32, len(found))

    def windows(self, item: int) -> np.ndarray:
        return self.window_of[self.edges[item] : self.edges[item + 1]]


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that compare in row order."""
    wide = np.ascontiguousarray(rows.astype(">u4"))
    return wide.view(f"S{4 * rows.shape[1]}").reshape(-1)


def candidates(ids: np.ndarray, tests: TestSuffixes) -> np.ndarray:
    """Positions at which a chain of benchmark word pairs of the needed length starts.

    `ids` holds the shard's documents, each followed by a zero.
    """
    known = ids > 0
    linked = np.zeros(len(ids), bool)  # does a benchmark word pair start here?
    linked[:-1] = known[:-1] & known[1:]
    at = np.flatnonzero(linked)
    linked[at] = tests.pairs[_mix(ids[at], ids[at + 1])]
    # Length of the chain of pairs starting at each position.
    breaks = np.where(linked, len(ids), np.arange(len(ids)))
    chain = np.minimum.accumulate(breaks[::-1])[::-1] - np.arange(len(ids))
    return np.flatnonzero(known & (chain >= tests.shortest - 1))


def suffix_array(padded: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys, through the window length, of the suffixes at `at`, and their positions."""
    table = padded[at[:, None] + np.arange(window)]
    # A suffix ends at its document's end.
    table[np.logical_or.accumulate(table == 0, axis=1)] = 0
    keys = _keys(table)
    order = np.argsort(keys, kind="stable")
    return keys[order], at[order]


def _spread(first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the ranges `first` to `first + counts`, and the range of each."""
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts - first, counts)


def occurrences(ids: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of (window, position) where the window occurs, by position.

    A position starts at most one window of each size, so the pairs are as many as the words,
    however often words or windows repeat on either side.
    """
    found = [np.zeros((2, 0), np.int64)]
    if tests.shortest and len(ids):
        padded = np.concatenate([ids, np.zeros(tests.window, ids.dtype)])
        at = candidates(ids, tests)
        for a in range(0, len(at), ARRAY):  # arrays of bounded size, also for a document of any length
            keys, where = suffix_array(padded, at[a : a + ARRAY], tests.window)
            low = np.searchsorted(keys, tests.low, "left")
            which, row = _spread(low, np.searchsorted(keys, tests.high, "right") - low)
            found.append(np.stack([which, where[row]]))
    window, at = np.concatenate(found, axis=1)
    order = np.lexsort((window, at))
    return window[order], at[order]


def longest_run(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Start in `a`, start in `b` and length of the longest run of equal values that both hold;
    of several the first in `b`, then in `a`. Negative values match nothing.

    Runs of 2, 4, 8 ... values are numbered by pairs of runs half as long, and the longest
    common length is put together from such powers: equal values that repeat cost nothing extra.
    """
    n = len(a) + len(b) + 2
    in_b = np.arange(n) > len(a)

    def shared(left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
        """Numbers of the runs `left` followed, `step` on, by `right`; -1 unless on both sides."""
        out = np.full(n, -1)
        ok = np.flatnonzero((left[: n - step] >= 0) & (right[step:] >= 0))
        _, run = np.unique(left[ok] << 32 | right[ok + step], return_inverse=True)
        sides = np.zeros((2, len(ok)), bool)
        sides[in_b[ok].astype(int), run] = True
        out[ok] = np.where(sides.all(axis=0)[run], run, -1)
        return out

    ids = np.concatenate([a, [-1], b, [-1]]).astype(np.int64)
    powers = [shared(ids, ids, 0)]
    if (powers[0] < 0).all():
        return 0, 0, 0
    while ((longer := shared(powers[-1], powers[-1], 1 << (len(powers) - 1))) >= 0).any():
        powers.append(longer)
    runs, length = powers[-1], 1 << (len(powers) - 1)
    for k in reversed(range(len(powers) - 1)):
        longer = shared(runs, powers[k], length)
        if (longer >= 0).any():
            runs, length = longer, length + (1 << k)
    start = int(np.flatnonzero((runs >= 0) & in_b)[0])
    return int(np.flatnonzero(runs == runs[start])[0]), start - len(a) - 1, length


def _longest_matches(window: np.ndarray, at: np.ndarray, tests: TestSuffixes) -> list[dict]:
    """The longest match of one document with each item of which it holds a window, by item.

    `window` and `at` are the document's occurrences, by position. Where all windows of the
    document and an item stand once on either side, their places are paired off; else the
    longest run common to both is looked for.
    """
    held, first, times = np.unique(window, return_index=True, return_counts=True)
    which, row = _spread(tests.first[held], tests.first[held + 1] - tests.first[held])
    item, place, pos = tests.item[row], tests.place[row], at[first[which]]
    order = np.lexsort((place, pos - place, item))
    item, place, pos, row, which = (x[order] for x in (item, place, pos, row, which))
    many = np.zeros(len(tests.items), bool)
    many[item[(times[which] > 1) | (tests.times[row] > 1)]] = True
    found = []
    single = ~many[item]
    item_1, place_1, pos_1 = item[single], place[single], pos[single]
    if len(item_1):
        new = (np.diff(item_1) != 0) | (np.diff(pos_1 - place_1) != 0) | (np.diff(place_1) != 1)
        start = np.concatenate([[0], np.flatnonzero(new) + 1])
        length = np.diff(np.append(start, len(item_1)))
        best = np.lexsort((pos_1[start], place_1[start], -length, item_1[start]))
        best = best[np.concatenate([[True], np.diff(item_1[start][best]) != 0])]
        found += zip(item_1[start[best]].tolist(), place_1[start[best]].tolist(), pos_1[start[best]].tolist(), length[best].tolist(), strict=True)
    for i in np.flatnonzero(many).tolist():
        theirs = tests.windows(i)
        on = np.isin(window, theirs)
        gaps = np.flatnonzero(np.diff(at[on]) != 1) + 1  # a run does not go over a gap
        place_a = np.insert(at[on], gaps, -1)
        a, b, length = longest_run(np.insert(window[on], gaps, -1), theirs)
        found.append((i, b, int(place_a[a]), length))
    size = lambda i: int(tests.size[tests.window_of[tests.edges[i]]])
    return [{"item_id": tests.items[i], "item_word": p, "doc_word": d, "n_words": n + size(i) - 1} for i, p, d, n in sorted(found)]


def _search(texts_: list[bytes], tests: TestSuffixes) -> list[tuple[int, np.ndarray, list[dict]]]:
    """Per document: number of words, hit words, longest matches."""
    arrays = [tests.ids(t) for t in texts_]
    sizes = np.array([len(a) for a in arrays], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    zero = np.zeros(1, np.int32)
    shard = np.concatenate([x for a in arrays for x in (a, zero)]) if arrays else zero[:0]
    window, at = occurrences(shard, tests)
    hits = np.zeros(len(shard) + 1, np.int32)
    np.add.at(hits, at, 1)
    np.add.at(hits, at + tests.size[window], -1)
    hit = np.cumsum(hits)[:-1] > 0
    cuts = np.searchsorted(at, starts)
    out = []
    for n, s, a, z in zip(sizes.tolist(), starts.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=False):
        out.append((n, hit[s : s + n], _longest_matches(window[a:z], at[a:z] - s, tests) if z > a else []))
    return out


def _blocks(benchmark: DataFrame, block_bytes: int, item_col: str) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark's items in blocks of at most about `block_bytes`."""
    items = benchmark.select(F.col(item_col).cast("string").alias("_item"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // block_bytes + 1
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64("_item", "text"), F.lit(n)) == b) if n > 1 else items
        yield [(r["_item"], r["text"].encode()) for r in part.collect()]


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = 13, item_col: str = "item_id", shard_words: int = 1_000_000, block_bytes: int = 4 << 20) -> DataFrame:
    """`docs` with `n_words`, `n_hit`, `hits` (a bitmap over words) and `matches` (the longest
    verbatim match with each item, and its places); of `docs` only `text` is looked at."""
    spark = docs.sparkSession
    first = docs.select("*", F.lit(0).cast("bigint").alias("n_words"), F.lit(0).cast("bigint").alias("n_hit"), F.lit(None).cast("binary").alias("hits"), F.array().cast(MATCHES).alias("matches"))
    found = first
    schema = first.schema
    for block in _blocks(benchmark, block_bytes, item_col):
        tests = spark.sparkContext.broadcast(TestSuffixes(block, window))

        def run(batches: Iterator[pa.RecordBatch], tests=tests) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in _shards(batch, shard_words):
                    results = _search(list(texts(part)), tests.value)
                    hits, counts, matches = [], [], []
                    for (n, hit, new), old, had in zip(results, part.column("hits"), part.column("matches"), strict=True):
                        if old.is_valid:
                            hit = hit | np.unpackbits(np.frombuffer(old.as_py(), np.uint8), count=n).astype(bool)
                        hits.append(np.packbits(hit).tobytes())
                        counts.append(int(np.count_nonzero(hit)))
                        matches.append((had.as_py() or []) + new)
                    columns = dict(zip(part.schema.names, part.columns, strict=True))
                    columns["n_words"] = pa.array([r[0] for r in results], pa.int64())
                    columns["n_hit"] = pa.array(counts, pa.int64())
                    columns["hits"] = pa.array(hits, pa.binary())
                    columns["matches"] = pa.array(matches, part.schema.field("matches").type)
                    yield pa.RecordBatch.from_arrays(list(columns.values()), schema=part.schema)

        found = found.mapInArrow(tidy(run), schema)
    return found


def _shards(batch: pa.RecordBatch, shard_words: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about `shard_words` words, judged by bytes; a document is whole."""
    lengths = np.array([v.as_buffer().size if v.is_valid else 0 for v in batch.column("text")], np.int64)
    group = np.cumsum(lengths) // (shard_words * 6)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(lengths)]]) if len(lengths) else [0, 0]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(int(a), int(b - a))


def judged(found: DataFrame, min_share: int = 20) -> DataFrame:
    """Adds `items` (sorted distinct ids) and `contaminated` to found matches."""
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    out = found.withColumn("items", F.filter(items, lambda i: i.isNotNull()))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * min_share >= F.col("n_words")))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The registered query's columns."""
    found = judged(find_matches(docs.select("doc_id", "text"), benchmark))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, that are not contaminated."""
    rows = docs.select(F.struct("*").alias("_row"), "text")
    return judged(find_matches(rows, benchmark)).where(~F.col("contaminated")).select("_row.*")
