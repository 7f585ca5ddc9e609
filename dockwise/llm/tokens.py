"""Token ids as binary shards with a shared zstandard dictionary.

Format of a shard (little endian): ``DWTOK001``, the SHA-256 of the dictionary, one
zstandard frame per document holding its ids as unsigned 32-bit integers, then an index of
ids, frame offsets and token counts, and a footer locating the index. A short document is
read by seeking to its frame; its neighbours are not decompressed. The dictionary is
trained on serialized id arrays and stored once beside the shards, named by its hash.

Documents are range-partitioned by id, sorted, and encoded after the shuffle, so that text,
the smaller form, is what moves, and each task writes one shard. A shard gets its final
name when it is complete, so a repeated task leaves nothing partial. Positions of shards are
a running sum over one row per shard.

Encoding is word by word through a bounded cache. That equals encoding the whole text for
tokenizers that discard white space and never merge across it (``word_bpe_49k.json``):
texts are cut only at U+0020 and U+000A, which no token, special token or normalization
step spans. Texts are cut in Arrow, some megabytes at a time, and only the distinct words of
such a part are looked up; their ids are then gathered in the order of the words. Latin words
are looked up in lower case and without the ASCII punctuation behind them, which is a token
sequence of its own. They go to the merge model after the tokenizer's own normalizer and byte
mapping; anything else goes through the whole tokenizer.

Defined cases: null or empty text holds the end id only; null ids come first; equal ids
are ordered by a hash of the text; fully repeated rows are separate documents; an empty
table gives an empty result. Ids must be integers.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from dockwise.llm.common import filesystem, running_offsets, shared_folder, stage, tidy

MAGIC = b"DWTOK001"
FOOTER = "<QQ8s"
EXTENSION = ".tok"
LATIN_END = "ɐ"
PART = 4 << 20  # bytes of text cut into words at a time


class WordIds(dict):
    """Serialized ids of a chunk of text without spaces; two generations of `limit` entries."""

    def __init__(self, tokenizer_json: str, limit: int) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model, self.normalizer = self.tokenizer.model, self.tokenizer.normalizer
        self.limit, self.older = limit, {}
        # Bytes without a printable character of their own have one beyond the first 256.
        signs = set(ByteLevel.alphabet())
        further = iter(sorted(c for c in signs if ord(c) > 255))
        self.mapping = {b: next(further) for b in range(256) if chr(b) not in signs}

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return np.array(ids, dtype="<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            # Capitals and punctuation behind a word are not stored again.
            word = chunk.rstrip(punctuation)
            if word.isalpha():
                if word != chunk:
                    return self[word] + self[chunk[len(word) :]]
                lower = word.lower()
                if lower != word and lower.isalpha() and max(word) < LATIN_END:
                    return self[lower]
            ids = self._encode(chunk)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[chunk] = ids
        return ids

    def _encode(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        if chunk.isalpha() and max(chunk) < LATIN_END:
            if chunk.isascii():
                return self._pack([t.id for t in self.model.tokenize(chunk)])
            normal = self.normalizer.normalize_str(chunk)
            if normal.isalpha():
                mapped = normal.encode().decode("latin-1").translate(self.mapping)
                return self._pack([t.id for t in self.model.tokenize(mapped)])
        return self._pack(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def texts(self, column: pa.Array, end: bytes) -> Iterator[bytes]:
        """Ids of each whole text of a column (null: empty) and the end id."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        edges = [*np.flatnonzero(np.diff(ends // PART, prepend=-1)).tolist(), len(column)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            at, data = self._part(column.slice(a, b - a))
            for x, y in zip(at[:-1], at[1:], strict=True):
                yield data[x:y].tobytes() + end
            del data
            pa.default_memory_pool().release_unused()  # else every worker keeps what its largest part took

    def _part(self, column: pa.Array) -> tuple[list[int], memoryview]:
        """Ids of some texts, one after the other, and the places where texts begin and end."""
        spaced = pc.replace_substring(pc.fill_null(column.cast(pa.large_string()), ""), "\n", " ")
        words = pc.split_pattern(spaced, " ")
        edges, coded = words.offsets.to_numpy(), words.flatten().dictionary_encode()
        del spaced, words  # the texts are needed no more
        of = pa.array([self[w] for w in coded.dictionary.to_pylist()], pa.large_binary())
        ids = of.take(coded.indices)
        at = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[edges].tolist()
        return at, memoryview(ids.buffers()[2] or b"")

    def text(self, text: str, end: bytes) -> bytes:
        """Ids of a whole text and the end id."""
        return next(self.texts(pa.array([text]), end))


CACHE = 600_000
_ENCODERS: dict[str, WordIds] = {}  # one per worker process and tokenizer


def _encoder(tokenizer_json: str, limit: int = CACHE) -> WordIds:
    name = hashlib.sha256(tokenizer_json.encode()).hexdigest()
    if name not in _ENCODERS:
        _ENCODERS[name] = WordIds(tokenizer_json, limit)
    _ENCODERS[name].limit = limit
    return _ENCODERS[name]


def _forget() -> None:
    """Drop this worker's caches."""
    _ENCODERS.clear()


def _check(tokenizer_json: str) -> None:
    spec = json.loads(tokenizer_json)
    steps = json.dumps([spec["normalizer"], spec["pre_tokenizer"]])
    if "Lowercase" not in steps or '"invert": true' not in steps or spec["model"].get("end_of_word_suffix") != "</w>":
        raise ValueError("word-wise encoding needs a tokenizer that lower-cases, drops white space and marks word ends")


def train_dictionary(docs: DataFrame, tokenizer_json, end: bytes, sample_docs: int = 1000, dict_bytes: int = 64 << 10, sample_bytes: int = 4 << 20, cache: int = CACHE) -> bytes:
    """A zstandard dictionary from the ids of at most `sample_docs` documents.

    The sample is those with the smallest hash of their id. At most `sample_bytes` of ids
    are used, each document giving an equal share. Too small samples become the dictionary
    as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _encoder(tokenizer_json.value, cache)
        for batch in batches:
            out = [x[: sample_bytes // sample_docs] for x in ids.texts(batch.column("text"), end)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])

    # The cut is found on ids alone, so no task or driver merges more texts than the sample.
    order = F.xxhash64("_id")
    least = docs.select(order.alias("o")).orderBy("o").limit(sample_docs).agg(F.max("o")).first()[0]
    sample = docs.where(order <= F.lit(least if least is not None else 0)).limit(sample_docs)
    samples = [bytes(r["ids"]) for r in sample.select("text").mapInArrow(run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(dict_bytes, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:dict_bytes]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", cache: int = CACHE) -> DataFrame:
    """Write `docs` below `folder`; one row per shard: `(shard, path, docs, tokens)`.

    A worker remembers the ids of at most twice `cache` words, each taking about 200 bytes.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    _check(text)
    tokenizer_json = spark.sparkContext.broadcast(text)
    end = np.array([end_id], "<u4").tobytes()
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), "text").withColumn("_h", F.xxhash64("text"))
    raw = train_dictionary(rows, tokenizer_json, end, cache=cache)
    files, base = filesystem(folder)
    files.create_dir(base, recursive=True)
    with files.open_output_stream(f"{base}/{hashlib.sha256(raw).hexdigest()}.dict", compression=None) as out:
        out.write(raw)
    dictionary = spark.sparkContext.broadcast(raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = filesystem(folder)
        context, ids_of = TaskContext.get(), _encoder(tokenizer_json.value, cache)
        shard = context.partitionId()
        final, draft = f"{base}/shard-{shard:06d}{EXTENSION}", f"{base}/_draft-{context.taskAttemptId()}"
        packer = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(dictionary.value), write_dict_id=False)
        doc_ids, valid, offsets, counts = [], [], [], []
        with files.open_output_stream(draft, compression=None) as out:
            at = out.write(MAGIC + hashlib.sha256(dictionary.value).digest())
            at = len(MAGIC) + 32
            for batch in batches:
                for doc_id, ids in zip(batch.column("_id").to_pylist(), ids_of.texts(batch.column("text"), end), strict=True):
                    frame = packer.compress(ids)
                    out.write(frame)
                    doc_ids.append(doc_id or 0)
                    valid.append(doc_id is not None)
                    offsets.append(at)
                    counts.append(len(ids) // 4)
                    at += len(frame)
            arrays = (np.array(doc_ids, "<i8"), np.array(valid, "u1"), np.array([*offsets, at], "<u8"), np.array(counts, "<u4"))
            for a in arrays:
                out.write(a.tobytes())
            out.write(struct.pack(FOOTER, at, len(doc_ids), MAGIC))
        files.move(draft, final)
        yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [f"{folder}/shard-{shard:06d}{EXTENSION}"], "docs": [len(doc_ids)], "tokens": [int(sum(counts))]})

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "_id", "_h").sortWithinPartitions("_id", "_h")
    return stage(ordered.select("_id", "text").mapInArrow(run, "shard long, path string, docs long, tokens long"), "token-manifest")


class Shard:
    """Random access to one shard: the index is read, documents are sought."""

    def __init__(self, source, dictionary: bytes) -> None:
        size = source.size()
        source.seek(size - struct.calcsize(FOOTER))
        at, n, magic = struct.unpack(FOOTER, source.read(struct.calcsize(FOOTER)))
        source.seek(0)
        head = source.read(len(MAGIC) + 32)
        if magic != MAGIC or head[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token shard")
        if head[len(MAGIC) :] != hashlib.sha256(dictionary).digest():
            raise ValueError("the shard was written with another dictionary")
        source.seek(at)
        raw = source.read(size - struct.calcsize(FOOTER) - at)
        self.doc_ids = np.frombuffer(raw, "<i8", n)
        self.valid = np.frombuffer(raw, "u1", n, 8 * n).astype(bool)
        self.offsets = np.frombuffer(raw, "<u8", n + 1, 9 * n)
        self.counts = np.frombuffer(raw, "<u4", n, 9 * n + 8 * (n + 1))
        self.source = source
        self.unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def ids(self, i: int) -> bytes:
        """Serialized ids of the shard's document `i`."""
        start = int(self.offsets[i])
        self.source.seek(start)
        return self.unpacker.decompress(self.source.read(int(self.offsets[i + 1]) - start))


def open_shard(path: str) -> Shard:
    files, place = filesystem(path)
    source = files.open_input_file(place)
    source.seek(len(MAGIC))
    name = source.read(32).hex()
    with files.open_input_stream(f"{place.rpartition('/')[0]}/{name}.dict", compression=None) as d:
        return Shard(source, d.read())


def _read(manifest: DataFrame, column: str, kind: str, of, to_arrow: pa.DataType, forget: bool = False) -> DataFrame:
    """Every document of the shards, with `of` its serialized ids as `column`; `forget` drops the
    word caches of the workers that read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if forget:
            _forget()
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist(), strict=True):
                shard = open_shard(path)
                starts = before + np.concatenate([[0], np.cumsum(shard.counts, dtype=np.int64)])
                step = 500
                for a in range(0, len(shard.doc_ids), step):
                    b = min(a + step, len(shard.doc_ids))
                    ids = [shard.ids(i) for i in range(a, b)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.doc_ids[a:b], mask=~shard.valid[a:b]),
                            pa.array(starts[a:b]),
                            pa.array([len(x) // 4 for x in ids], pa.int64()),
                            pa.array([of(x) for x in ids], to_arrow),
                        ],
                        ["doc_id", "start", "n_tokens", column],
                    )

    spark = manifest.sparkSession
    placed = running_offsets(manifest.select("shard", "path", "tokens"), ["shard"], "tokens")
    tasks = placed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard")
    return tasks.select("path", "before").mapInArrow(tidy(run) if forget else run, f"doc_id long, start long, n_tokens long, {column} {kind}")


def read_shards(manifest: DataFrame) -> DataFrame:
    """`doc_id, start, n_tokens, ids` of every document; ids as little-endian 32-bit integers."""
    return _read(manifest, "ids", "binary", lambda ids: ids, pa.binary())


def checksums(manifest: DataFrame, forget: bool = False) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` of every document."""
    return _read(manifest, "ids_crc32", "long", zlib.crc32, pa.int64(), forget)


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 1, cache: int = CACHE, forget: bool = False) -> DataFrame:
    """The registered query: write the shards, read them back."""
    manifest = write_shards(docs, shared_folder(spark, "tokens"), tokenizer_path, end_id, cache=cache)
    return checksums(manifest, forget)
