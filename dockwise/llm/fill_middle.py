"""Fill-in-middle: texts cut at token boundaries and rearranged as prefix, suffix, middle.

A token is a run of characters that are no white space with the white space before it; white
space at the end of a text is one more token. Where a document is cut is found by
content-defined chunk memoization:

* a rolling hash (a gear hash of the last 32 bytes) cuts the UTF-8 bytes where it is small, so
  that equal passages of different documents fall into equal chunks; `LEAST` and `MOST` bound a
  chunk, cuts by `MOST` being at fixed steps from the last cut;
* a chunk's summary is its number of word runs and whether its first and last bytes are white
  space. Summaries are kept in a bounded cache under the chunk's hash; a hit counts only if the
  stored content is the same. Summaries combine (two chunks meeting inside a word share a run),
  and their running sum over a document gives the chunk in which a token ends. Only that chunk
  is looked into.

Work is a narrow pass over the documents: no shuffle, whatever documents have in common. The
cache is per worker process and changes nothing but time.

Defined cases: a null text is empty, and empty texts are plain (no tokens); a null id is hashed as
the empty string; texts holding one of the markers are plain; repeated rows give equal rows;
other columns are not read. Lengths are code points, null for plain documents. `restore` gives
back the text from the output and the form alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dockwise.llm.common import texts

# The markers and the white space of the token pattern.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SPACE = b" \t\n\x0b\x0c\r"

LEAST, MOST = 256, 8192  # bytes of a chunk
MASK = np.uint32((1 << 10) - 1)  # a cut every KiB beyond the least
STRIP = 1 << 22  # bytes hashed at a time
CACHE_BYTES = 48 << 20
GEAR = np.random.default_rng(11).integers(0, 1 << 32, 256, dtype=np.uint32)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACE)] = True

Summary = tuple[int, bool, bool]  # word runs, first byte in a word, last byte in a word


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of the 32 bytes ending there, by doubling windows."""
    h = GEAR[data]
    for width in (1, 2, 4, 8, 16):
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
    return h


def chunk_ends(text: bytes) -> list[int]:
    """Ends of the content-defined chunks of a text."""
    n, ends, last = len(text), [], 0
    data = np.frombuffer(text, np.uint8)
    for a in range(0, n, STRIP):
        lead = min(a, 31)  # bytes before the strip that its first hashes need
        h = rolling_hash(data[a - lead : a + STRIP])[lead:]
        for cut in (np.flatnonzero((h & MASK) == 0) + (a + 1)).tolist():
            while cut - last > MOST:
                last += MOST
                ends.append(last)
            if cut - last >= LEAST:
                last = cut
                ends.append(last)
    while n - last > MOST:
        last += MOST
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def summary(chunk: bytes) -> Summary:
    return len(chunk.split()), chunk[0] not in SPACE, chunk[-1] not in SPACE


class Summaries:
    """Summaries by content; two generations of `limit` bytes of chunks."""

    def __init__(self, limit: int = CACHE_BYTES // 2) -> None:
        self.limit, self.held = limit, 0
        self.newer: dict[int, tuple[bytes, Summary]] = {}
        self.older: dict[int, tuple[bytes, Summary]] = {}

    def of(self, chunk: bytes) -> Summary:
        key = xxhash.xxh3_64_intdigest(chunk)
        found = self.newer.get(key)
        if found is not None and found[0] == chunk:
            return found[1]
        found = self.older.get(key)
        made = found[1] if found is not None and found[0] == chunk else summary(chunk)
        if self.held >= self.limit:
            self.newer, self.older, self.held = {}, self.newer, 0
        self.newer[key] = chunk, made
        self.held += len(chunk)
        return made


class Cuts:
    """Token counts of a text by its chunks, and the places where given tokens end."""

    def __init__(self, text: bytes, cache: Summaries) -> None:
        self.text, self.ends = text, chunk_ends(text)
        self.runs = []  # word runs that begin before each chunk's end
        total, in_word, start = 0, False, 0
        for end in self.ends:
            runs, first, last = cache.of(text[start:end])
            total += runs - (in_word and first)
            in_word, start = last, end
            self.runs.append(total)
        self.n = total + (bool(text) and not in_word)

    def end_of(self, token: int) -> int:
        """Bytes up to the end of the first `token` tokens."""
        if token <= 0:
            return 0
        if token >= self.n:
            return len(self.text)
        # The run begins in the first chunk that reaches the count, and may end in a later one.
        at = int(np.searchsorted(self.runs, token))
        start = self.ends[at - 1] if at else 0
        chunk = np.frombuffer(self.text, np.uint8, self.ends[at] - start, start)
        word = ~IS_SPACE[chunk]
        begins = np.flatnonzero(word & np.concatenate([[not (start and self.text[start - 1] not in SPACE)], ~word[:-1]]))
        place = start + int(begins[token - (self.runs[at - 1] if at else 0) - 1])
        while True:
            blank = np.flatnonzero(IS_SPACE[np.frombuffer(self.text, np.uint8, min(MOST, len(self.text) - place), place)])
            if len(blank):
                return place + int(blank[0])
            place = min(place + MOST, len(self.text))
            if place == len(self.text):
                return place


def draws(seed: int, doc_id) -> list[int]:
    """Four 32-bit numbers of a document."""
    name = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(name[i : i + 8], 16) for i in (0, 8, 16, 24)]


def rearrange(text: bytes, doc_id, cache: Summaries, seed: int, percent: int, spm_percent: int) -> tuple[bytes, str, int, int | None, int | None]:
    """Output, form, tokens, and code points of prefix and middle (none if plain)."""
    cuts = Cuts(text, cache)
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not text or h3 % 100 >= percent or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return text, "plain", cuts.n, None, None
    a, b = sorted((h1 % (cuts.n + 1), h2 % (cuts.n + 1)))
    p, q = cuts.end_of(a), cuts.end_of(b)
    prefix, middle, suffix = text[:p], text[p:q], text[q:]
    sizes = len(prefix.decode()), len(middle.decode())
    if h4 % 100 < spm_percent:
        return SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle, "spm", cuts.n, *sizes
    return PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle, "psm", cuts.n, *sizes


def original(output: bytes, form: str) -> bytes:
    """The text, from the output and the form (the text holds no marker)."""
    if form == "plain":
        return output
    second = SUFFIX if form == "psm" else PREFIX
    first, _, rest = output[3:].partition(second)
    other, _, middle = rest.partition(MIDDLE)
    return first + middle + other if form == "psm" else other + middle + first


_CACHE = Summaries()  # one per worker process


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80, id_col: str = "doc_id") -> DataFrame:
    """The id, `output`, `form` (plain, psm, spm), `n` tokens, `prefix_chars`, `middle_chars`.

    `percent` of the documents are rearranged, `spm_percent` of those with the suffix first;
    which and where is drawn from a hash of the seed and the id.
    """
    rows = docs.select(F.col(id_col).alias("id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            made = [rearrange(t, i, _CACHE, seed, percent, spm_percent) for t, i in zip(texts(batch), ids, strict=True)]
            output, form, n, prefix, middle = zip(*made, strict=True) if made else [()] * 5
            long = [pa.array(c, pa.int64()) for c in (n, prefix, middle)]
            text = pa.array(output, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), text, pa.array(form, pa.string()), *long], [id_col, "output", "form", "n", "prefix_chars", "middle_chars"]
            )

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, output string, form string, n long, prefix_chars long, middle_chars long")


def restore(made: DataFrame) -> DataFrame:
    """Adds `restored`, the text rebuilt from `output` and `form` (nothing else is read)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column("form").to_pylist()
            out = [original(o, f) for o, f in zip(texts(batch, "output"), forms, strict=True)]
            restored = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, restored], [*batch.schema.names, "restored"])

    return made.mapInArrow(run, StructType([*made.schema.fields, StructField("restored", StringType())]))


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns."""
    back = restore(fill_in_middle(docs))
    return back.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )
