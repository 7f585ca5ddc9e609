"""Byte-level BPE: text to token ids and back, by a rank file.

A text is cut into pre-tokens by the vocabulary's pattern; each pre-token is looked up in two
tiers:

* a minimal perfect hash over the vocabulary: levels of bits, each key in the first level where
  no other key falls on its bit, its number being the count of bits before it. The key stored
  under that number is compared, so a pre-token is resolved if and only if it is a vocabulary
  entry as a whole;
* otherwise its bytes are a linked list, and a heap of (rank, place) of neighbouring pairs gives
  the next merge: the lowest rank, the leftmost of equals. Entries whose pair has changed since
  are skipped. A merge costs a logarithm of the length, so long runs are no quadratic case.

Ids of short pre-tokens are remembered in a bounded table of two generations. The vocabulary
(a file of fixed size, read on the driver) is broadcast; texts are never moved between tasks.
Long texts are cut into parts at the end of a word before white space, where no pre-token of the
pattern spans, so that pre-tokens of a part only are in memory.

Defined cases: a null text is an empty one, which has no ids; strings of special tokens are
ordinary text; repeated rows and null ids give a row each; empty tables give empty results;
other columns are not read. Decoding gives bytes, as ids need not form valid UTF-8; a null id
array decodes to no bytes, an id outside the vocabulary is an error.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = 1 << 20  # characters cut into pre-tokens at a time
REMEMBERED = 64  # longest pre-token kept in the table
HELD_IDS = 1 << 21  # ids of an output batch
PLACE_BITS = 40
WORD_END = regex.compile(r"\S(?=\s)")


class PerfectHash:
    """A minimal perfect hash: `number(key)` is a bijection of its keys to 0 .. n-1.

    Any other key gets some number or -1, so callers compare the key stored under it.
    """

    def __init__(self, keys: list[bytes], room: float = 2.0) -> None:
        self.sizes: list[int] = []
        self.taken: list[bytes] = []
        self.numbers: list[list[int]] = []
        before, left = 0, list(keys)
        while left:
            level = len(self.sizes)
            size = max(1, int(room * len(left)))
            at = np.array([xxhash.xxh3_64_intdigest(k, level) % size for k in left])
            alone = np.bincount(at, minlength=size) == 1
            self.sizes.append(size)
            self.taken.append(alone.tobytes())
            self.numbers.append((np.cumsum(alone) - 1 + before).tolist())
            before += int(alone.sum())
            left = [k for k, placed in zip(left, alone[at], strict=True) if not placed]

    def number(self, key: bytes) -> int:
        for level, size in enumerate(self.sizes):
            at = xxhash.xxh3_64_intdigest(key, level) % size
            if self.taken[level][at]:
                return self.numbers[level][at]
        return -1


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and a decimal rank on each line."""
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing or len(set(ranks.values())) != len(ranks):
        raise ValueError("a rank file must hold every single byte, and each rank once")
    return ranks


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: neighbouring parts are merged in the order of the pairs' ranks."""
    n, rank_of, mask = len(piece), ranks.get, (1 << PLACE_BITS) - 1
    links = list if n < 4096 else lambda r: array("q", r)
    after, before = links(range(1, n + 1)), links(range(-1, n - 1))
    heap = [r << PLACE_BITS | i for i in range(n - 1) if (r := rank_of(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        entry = heappop(heap)
        i = entry & mask
        j = after[i]
        if j < 0 or j >= n:
            continue  # the part was merged into its left neighbour, or is the last
        end = after[j]
        if rank_of(piece[i:end]) != entry >> PLACE_BITS:
            continue  # the pair at this place has grown since
        after[i], after[j] = end, -1
        if end < n:
            before[end] = i
            r = rank_of(piece[i : after[end]])
            if r is not None:
                heappush(heap, r << PLACE_BITS | i)
        left = before[i]
        if left >= 0:
            r = rank_of(piece[left:end])
            if r is not None:
                heappush(heap, r << PLACE_BITS | left)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class Encoder(dict):
    """Serialized ids (32-bit, little endian) by pre-token; `limit` entries a generation."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, limit: int = 400_000) -> None:
        super().__init__()
        self.ranks, self.cut = ranks, regex.compile(pattern)
        self.hash = PerfectHash(list(ranks))
        self.keys_by_number = [b""] * len(ranks)
        self.ids_by_number = [b""] * len(ranks)
        for token, rank in ranks.items():
            number = self.hash.number(token)
            self.keys_by_number[number] = token
            self.ids_by_number[number] = rank.to_bytes(4, "little")
        self.limit, self.older = limit, {}

    def piece(self, raw: bytes) -> bytes:
        number = self.hash.number(raw)
        if number >= 0 and self.keys_by_number[number] == raw:
            return self.ids_by_number[number]
        return np.array(merged(raw, self.ranks), "<i4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.piece(piece.encode())
        if len(piece) <= REMEMBERED:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(b"".join(map(self.__getitem__, self.cut.findall(part))) for part in parts(text))


def parts(text: str) -> Iterator[str]:
    """The text in parts of about `PART` characters, each ending with a word before a space."""
    start = 0
    while start < len(text):
        found = WORD_END.search(text, start + PART) if len(text) - start > PART else None
        end = found.end() if found else len(text)
        yield text[start:end]
        start = end


_ENCODERS: dict[str, Encoder] = {}  # one per worker process, rank file and pattern


def _encoder(raw: bytes, pattern: str) -> Encoder:
    name = hashlib.sha256(raw + pattern.encode()).hexdigest()
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(read_ranks(raw), pattern)
    return _ENCODERS[name]


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _id_lists(ids: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col` and `ids array<int>` of every text."""
    raw = docs.sparkSession.sparkContext.broadcast(_read(rank_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(raw.value, pattern)
        for batch in batches:
            first, held, out = 0, 0, []
            for row, text in enumerate(batch.column("text")):
                out.append(encoder.encode(text.as_py() or ""))
                held += len(out[-1]) // 4
                if held >= HELD_IDS:
                    yield pa.RecordBatch.from_arrays([batch.column("id").slice(first, len(out)), _id_lists(out)], [id_col, "ids"])
                    first, held, out = row + 1, 0, []
            if out:
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(first, len(out)), _id_lists(out)], [id_col, "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema['id'].dataType.simpleString()}, ids array<int>")


def _tokens(raw: bytes) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(raw).items()}


def _decoded(tokens: dict[int, bytes], ids: list[int]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids))


def _id_arrays(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for v in batch.column("ids"):
        yield v.values.to_numpy() if v.is_valid else np.empty(0, np.int32)


def decode(encoded: DataFrame, rank_path: str, id_col: str = "doc_id") -> DataFrame:
    """`id_col` and `decoded binary` of every id array."""
    raw = encoded.sparkSession.sparkContext.broadcast(_read(rank_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(raw.value)
        for batch in batches:
            out = [_decoded(tokens, ids.tolist()) for ids in _id_arrays(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], [id_col, "decoded"])

    rows = encoded.select(F.col(id_col).alias("id"), "ids")
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema['id'].dataType.simpleString()}, decoded binary")


def digest(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """The registered query: ids, their digest, and the digest of the bytes decoded from them."""
    encoded = encode(docs, rank_path, pattern)
    raw = docs.sparkSession.sparkContext.broadcast(_read(rank_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(raw.value)
        decimal = {rank: str(rank) for rank in tokens}
        for batch in batches:
            counts, id_hashes, text_hashes = [], [], []
            for ids in map(np.ndarray.tolist, _id_arrays(batch)):
                counts.append(len(ids))
                id_hashes.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                text_hashes.append(hashlib.sha256(_decoded(tokens, ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_hashes), pa.array(text_hashes)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    id_type = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.mapInArrow(run, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
