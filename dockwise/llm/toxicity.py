"""Toxicity: a convolutional text classifier in numpy.

Words are embedded by hash functions into tables of `BUCKETS` rows, side by side: two of the
whole word, so that words look alike only if they collide in both, and one each of its first
four and five bytes, so that forms of a word share what is learned; filters of widths 1, 2 and
3 run over the whole text, each keeps its maximum, and a linear layer gives the logit. A
text of any length is scored in chunks whose maxima are combined: nothing is cut off.

Training takes every labelled document that is not held out, whole: they are written once, in
parts that follow the bytes of text. Embeddings start from the shrunken log-odds of their bucket,
counted over all parts, and are trained with the filters in `ROUNDS` rounds: a task a part
descends from the common model, some megabytes of text at a time, and what the parts found is
averaged block by block, each bucket over the parts that changed it. Three documents in four,
by a hash of the id, train the network; all others calibrate one threshold per language, from
counts over fine steps of the logit; the logit is
shifted by language so that the threshold stands at score 0.3. Language here is a reading of
the text alone (which language's accented letters are most frequent, if any), so labels,
lang, source and id never enter a score. The model, whose size is fixed, lies in the shared
folder; scoring is one pass over the documents by tasks that read it there.

Defined cases: null, empty and wordless texts get the score of an empty text; labels that
are null, or whose document is missing, do not train; of several labels the highest counts;
without labels of both classes, every score is the share of toxic training rows; if one of the
two parts would lack a class, all rows serve both; a null
id is not held out; repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockwise.llm.common import discard, filesystem, shared_folder, stage, texts, tidy
from dockwise.llm.near_dup import word_bytes
from dockwise.llm.suffix_dedup import Hasher, _mix

TABLES, BUCKETS, DIM = 4, 1 << 18, 8
PREFIX = (None, None, 4, 5)  # bytes of the word that each table hashes
WIDTHS, FILTERS = (1, 2, 3), 8
PAD = max(WIDTHS)  # so that an empty text has a window of every width
AT = 0.3
PRIOR = 30
ROUNDS, EPOCHS = 2, 2  # rounds of training, and epochs over what a task holds in each
BLOCK = 1 << 12  # buckets that are averaged together
PART_BYTES, LEAST_BYTES, LEAST_PARTS = 256 << 20, 8 << 20, 8
STEPS, SPAN = 256, 64  # steps of the logit per unit, and its bounds, in the thresholds' counts
CHUNK = 100_000  # words scored at a time

# Accented letters by language.
MARKS = {"de": "äöüß", "es": "ñáíóú", "fr": "çèêëàùîôœ"}


def language(text: str) -> str:
    """The language whose accented letters the text has most of; `other` if it has none."""
    counts = {k: sum(text.count(c) + text.count(c.upper()) for c in v) for k, v in MARKS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else "other"


def buckets(hasher: Hasher, docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per word the row in each table, every document followed by `PAD` blanks; and starts."""
    plain = [word_bytes(np.frombuffer(d + b" ", np.uint8)) for d in docs]
    size = np.array([len(p) for p in plain], np.int64)
    data = np.concatenate(plain) if plain else np.zeros(0, np.uint8)
    hasher.load(data)
    ends = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    doc = np.searchsorted(np.cumsum(size), starts, "right")
    n = np.bincount(doc, minlength=len(docs))
    first = np.cumsum(n + PAD) - (n + PAD)
    rows = np.full((int((n + PAD).sum()), TABLES), BUCKETS, np.int32)
    place = np.arange(len(starts)) + PAD * doc
    for t, prefix in enumerate(PREFIX):
        h = hasher.of(starts, ends if prefix is None else np.minimum(ends, starts + prefix))
        rows[place, t] = (_mix(h + np.uint64(t * 7919 + 1)) >> np.uint64(40)).astype(np.int64) % BUCKETS
    return rows, first


class Model:
    """Embeddings (with a zero row for blanks), filters, output layer, thresholds."""

    def __init__(self, prior: float) -> None:
        rng = np.random.default_rng(11)
        self.prior = prior
        self.embed = np.zeros((TABLES, BUCKETS + 1, DIM), np.float32)
        self.filters = [rng.normal(0, 0.3, (w, TABLES * DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        for f in self.filters:
            f[:, ::DIM] = np.abs(f[:, ::DIM])  # the log-odds dimension counts upwards at first
        self.bias = np.full(len(WIDTHS) * FILTERS, 0.1, np.float32)
        self.out = np.full(len(WIDTHS) * FILTERS, 0.2, np.float32)
        self.shift = np.float32(-2.0)
        self.levels: dict[str, float] = {}
        self.trained = False

    def lookup(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.embed[t][rows[:, t]] for t in range(TABLES)], axis=1)

    def pooled(self, x: np.ndarray, first: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Maximum of every filter over every document, and (for training) where it is."""
        stop = np.append(first[1:], len(x))
        feats, at = [], []
        for w, f in zip(WIDTHS, self.filters, strict=True):
            run = x[: len(x) - w + 1] @ f[0]
            for j in range(1, w):
                run += x[j : len(x) - w + 1 + j] @ f[j]
            # Windows of a document: all that end inside it, its blanks included.
            last = stop - w + 1
            edges = np.stack([first, last], axis=1).reshape(-1)
            run = np.concatenate([run, np.full((w, FILTERS), -np.inf, np.float32)])
            feats.append(np.maximum.reduceat(run, edges, axis=0)[::2])
            if where:
                at.append(np.stack([a + run[a:b].argmax(axis=0) for a, b in zip(first, last, strict=True)]))
        return np.concatenate(feats, axis=1), np.concatenate(at, axis=1) if where else None

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0) @ self.out + self.shift

    def raw(self, hasher: Hasher, docs: list[bytes]) -> np.ndarray:
        """Logits before calibration."""
        out = np.empty(len(docs))
        group: list[int] = []
        held = 0
        for i, d in enumerate([*docs, None]):
            if d is None or held > CHUNK * 6:
                if group:
                    rows, first = buckets(hasher, [docs[g] for g in group])
                    out[group] = self.logits(self._chunked(rows, first))
                group, held = [], 0
            if d is not None:
                group.append(i)
                held += len(d)
        return out

    def _chunked(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        if len(rows) <= 2 * CHUNK:
            return self.pooled(self.lookup(rows), first)[0]
        # Long texts in the group: one document at a time, in overlapping chunks.
        best = []
        for a, b in zip(first, np.append(first[1:], len(rows)), strict=True):
            parts = [self.pooled(self.lookup(rows[c : min(c + CHUNK + PAD, b)]), np.zeros(1, np.int64))[0] for c in range(a, max(a + 1, b - PAD), CHUNK)]
            best.append(np.max(parts, axis=0))
        return np.concatenate(best)

    def scores(self, hasher: Hasher, docs: list[bytes]) -> list[float]:
        if not self.trained:
            return [self.prior] * len(docs)
        z = self.raw(hasher, docs)
        level = np.array([self.levels.get(language(d.decode()), self.levels["all"]) for d in docs])
        return (1 / (1 + np.exp(-np.clip(z - level + _logit(AT), -30, 30)))).tolist()


def _logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


def train(docs: list[bytes], labels: np.ndarray, epochs: int = 4, batch: int = 64) -> Model:
    """Fit the network to texts in memory, then the thresholds on the last quarter.

    If either part would lack a class, all rows serve both. Labels of one class only leave the
    model untrained: it scores every text by their mean.
    """
    model = Model(float(labels.mean()) if len(labels) else 0.0)
    if len(set(labels.tolist())) < 2:
        return model
    cut = len(docs) * 3 // 4
    if not (0 < labels[:cut].sum() < cut and 0 < labels[cut:].sum() < len(docs) - cut):
        cut = len(docs)  # too few rows for a part of their own: thresholds from the training rows
    hasher = Hasher()
    data = [buckets(hasher, [d])[0] for d in docs[:cut]]
    y = labels[:cut].astype(np.float32)
    seen = np.zeros((TABLES, 2, BUCKETS), np.int64)
    _count(seen, data, y)
    model.embed[:, :BUCKETS, 0] = _odds(seen, float(y.mean()))
    Descent(model).run(data, y, epochs, batch)
    model.trained = True
    last = cut if cut < len(docs) else 0
    z = model.raw(hasher, docs[last:])
    model.levels = _calibrate(z, z, z, np.ones(len(z)), labels[last:], [language(d.decode()) for d in docs[last:]])
    return model


class Descent:
    """Adam for the filters and the output layer, Adagrad for the embeddings."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.dense = [*model.filters, model.bias, model.out]
        self.first_moment, self.second_moment = [np.zeros_like(p) for p in self.dense], [np.zeros_like(p) for p in self.dense]
        self.square = np.zeros_like(model.embed)
        self.step = 0
        self.rng = np.random.default_rng(5)

    def run(self, data: list[np.ndarray], y: np.ndarray, epochs: int, batch: int = 64) -> None:
        for _ in range(epochs):
            order = self.rng.permutation(len(data))
            for s in range(0, len(data), batch):
                some = order[s : s + batch]
                self._descend([data[i] for i in some], y[some])

    def _maxima(self, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximum of every filter over every document and its row; long texts in overlapping
        chunks, so that embeddings of a bounded number of words are held."""
        model, ends = self.model, np.cumsum(sizes)
        pieces = [(d, c, min(c + CHUNK + PAD, b)) for d, (a, b) in enumerate(zip(ends - sizes, ends, strict=True)) for c in range(a, max(a + 1, b - PAD), CHUNK)]
        best = np.full((len(sizes), len(model.bias)), -np.inf, np.float32)
        at = np.zeros(best.shape, np.int64)
        while pieces:
            group, held = [], 0
            while pieces and (not group or held + pieces[0][2] - pieces[0][1] <= 2 * CHUNK):
                group.append(pieces.pop(0))
                held += group[-1][2] - group[-1][1]
            size = np.array([b - a for _, a, b in group])
            first = np.cumsum(size) - size
            found, where = model.pooled(model.lookup(np.concatenate([rows[a:b] for _, a, b in group])), first, where=True)
            for k, (d, a, _) in enumerate(group):
                better = found[k] > best[d]
                best[d][better] = found[k][better]
                at[d][better] = where[k][better] - first[k] + a
        return best, at

    def _descend(self, data: list[np.ndarray], y: np.ndarray) -> None:
        model = self.model
        rows = np.concatenate(data)
        pooled, at = self._maxima(rows, np.array([len(d) for d in data]))
        active = pooled + model.bias > 0
        feats = np.maximum(pooled + model.bias, 0)
        error = 1 / (1 + np.exp(-(feats @ model.out + model.shift))) - y
        back = (error[:, None] * model.out) * active / len(y)
        places = [at[:, k * FILTERS : (k + 1) * FILTERS] + j for k, w in enumerate(WIDTHS) for j in range(w)]
        used, index = np.unique(np.stack(places), return_inverse=True)
        index = iter(index.reshape(len(places), *places[0].shape))
        rows = rows[used]
        x = model.lookup(rows)
        grads = []
        pull = np.zeros_like(x)
        for k, (w, f) in enumerate(zip(WIDTHS, model.filters, strict=True)):
            g = back[:, k * FILTERS : (k + 1) * FILTERS]
            df = np.empty_like(f)
            for j in range(w):
                place = next(index)
                df[j] = np.einsum("nf,nfd->df", g, x[place])
                np.add.at(pull, place.reshape(-1), (g[:, :, None] * f[j].T[None]).reshape(-1, f.shape[1]))
            grads.append(df)
        grads += [back.sum(axis=0), (feats * error[:, None]).mean(axis=0)]
        self.step += 1
        for p, g, m, v in zip(self.dense, grads, self.first_moment, self.second_moment, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= 0.005 * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)
        model.shift -= np.float32(0.05 * error.mean())
        hit = np.flatnonzero(np.abs(pull).sum(axis=1))
        for t in range(TABLES):
            b, g = rows[hit, t], pull[hit, t * DIM : (t + 1) * DIM]
            np.add.at(self.square[t], b, g * g)
            np.add.at(model.embed[t], b, -0.05 * g / (np.sqrt(self.square[t][b]) + 1e-6))
            model.embed[t][BUCKETS] = 0


def _count(seen: np.ndarray, data: list[np.ndarray], y: np.ndarray) -> None:
    """Add the documents, by class, that have each bucket."""
    for rows, label in zip(data, y, strict=True):
        for t in range(TABLES):
            found = np.unique(rows[:, t])
            seen[t, int(label), found[found < BUCKETS]] += 1


def _odds(seen: np.ndarray, share: float) -> np.ndarray:
    """First embedding dimension: shrunken log-odds of a bucket's documents being toxic, `share`
    being toxic over all."""
    n = seen.sum(axis=1)
    toxic = (seen[:, 1] + PRIOR * share) / (n + PRIOR)  # as if PRIOR average documents had the bucket
    return np.clip(np.log(toxic / (1 - toxic)) - np.log(share / (1 - share)), -4, 4).astype(np.float32)


def _calibrate(key: np.ndarray, low: np.ndarray, high: np.ndarray, n: np.ndarray, hits: np.ndarray, languages: list[str], least: int = 20) -> dict[str, float]:
    """Per language the logit level with the best F1, in the middle of the gap it lies in;
    languages with fewer than `least` toxic rows use the level of all.

    Each entry stands for `n` rows, `hits` of them toxic, with logits from `low` to `high`;
    entries of one `key`, which follows the logit, are not told apart.
    """
    spoken = np.array(languages)

    def level(pick: np.ndarray) -> float:
        keys, at = np.unique(-key[pick], return_inverse=True)
        rows, toxic = np.bincount(at, n[pick]), np.bincount(at, hits[pick])
        lowest, highest = np.full(len(keys), np.inf), np.full(len(keys), -np.inf)
        np.minimum.at(lowest, at, low[pick])
        np.maximum.at(highest, at, high[pick])
        k = int((2 * np.cumsum(toxic) / (np.cumsum(rows) + toxic.sum())).argmax())
        return float((lowest[k] + highest[k + 1]) / 2) if k + 1 < len(keys) else float(lowest[k]) - 1e-3

    out = {"all": level(np.ones(len(key), bool))}
    for name in set(languages):
        pick = spoken == name
        if hits[pick].sum() >= least and (n - hits)[pick].sum() >= least:
            out[name] = level(pick)
    return out


def held_out(doc_id: Column) -> Column:
    """Rows that never train: CRC-32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _stored_texts(files: pafs.FileSystem, names: list[str], most: int, column: str) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Texts and labels of a part's rows for which `column` holds, `most` bytes at a time (one
    text at least)."""
    held, marks, size = [], [], 0
    for name in names:
        with files.open_input_file(name) as source:
            for batch in pq.ParquetFile(source).iter_batches(64, columns=["text", "toxic", column]):
                for text, mark, use in zip(texts(batch), batch.column("toxic").to_pylist(), batch.column(column).to_pylist(), strict=True):
                    if not use:
                        continue
                    if held and size + len(text) > most:
                        yield held, np.array(marks, np.float32)
                        held, marks, size = [], [], 0
                    held.append(text)
                    marks.append(mark)
                    size += len(text)
    if held:
        yield held, np.array(marks, np.float32)


def _parquet_files(path: str) -> tuple[pafs.FileSystem, list[str]]:
    files, base = filesystem(path)
    return files, sorted(i.path for i in files.get_file_info(pafs.FileSelector(base, recursive=True)) if i.path.endswith(".parquet"))


def _merged(parts: DataFrame, merge, path: str) -> None:
    """Write the bodies that `merge(block, bodies, sizes)` makes of each block's, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries():
            for batch in batches:
                for i in range(batch.num_rows):
                    yield batch.column("block")[i].as_py(), batch.column("body")[i].as_py(), batch.column("size")[i].as_py()

        block, add, finish = None, None, None
        for b, body, size in entries():
            if b != block:
                if block is not None:
                    yield _entry(block, finish())
                block, (add, finish) = b, merge(b)
            add(np.frombuffer(body, np.float32), size)
        if block is not None:
            yield _entry(block, finish())

    def _entry(block: int, body: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([body.astype(np.float32).tobytes()], pa.binary())], ["block", "body"])

    spread = parts.repartition(LEAST_PARTS, "block").sortWithinPartitions("block", "part")
    spread.mapInArrow(tidy(run), "block long, body binary").write.parquet(path)


def _sum_of_counts(share: float):
    """Blocks of the start: the buckets' counts added, then their log-odds."""

    def merge(block: int):
        total = np.zeros((TABLES, 2, BLOCK))

        def add(body: np.ndarray, size: int) -> None:
            nonlocal total
            total += body.reshape(TABLES, 2, BLOCK)

        def finish() -> np.ndarray:
            out = np.zeros((TABLES, BLOCK, DIM), np.float32)
            out[:, :, 0] = _odds(total, share)
            return out

        return add, finish

    return merge


def _mean_of_parts(block: int):
    """A block of the model: the mean over the parts that changed a bucket (others hold NaN); the
    dense layers (block -1) are weighted by the parts' rows."""
    total = weight = None

    def add(body: np.ndarray, size: int) -> None:
        nonlocal total, weight
        if total is None:
            total, weight = np.zeros(body.shape), np.zeros(body.shape)
        known = ~np.isnan(body)
        by = size if block < 0 else 1
        total[known] += by * body[known].astype(np.float64)
        weight[known] += by

    def finish() -> np.ndarray:
        with np.errstate(invalid="ignore"):
            return total / weight

    return add, finish


def _block_rows(part: int, size: int, bodies: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for block, body in bodies:
        values = [pa.array([block], pa.int64()), pa.array([part], pa.int64()), pa.array([size], pa.int64()), pa.array([body.astype(np.float32).tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(values, ["block", "part", "size", "body"])


def fit(docs: DataFrame, labels: DataFrame, sample_bytes: int = 8 << 20, part_bytes: int = PART_BYTES) -> str | None:
    """Train on all labelled documents that are not held out; the folder of the model, None
    without labelled documents. A task holds `sample_bytes` of text, one at least, at a time."""
    allowed = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_y")).where(
        F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~held_out(F.col("_id"))
    )
    one = allowed.groupBy("_id").agg((F.max("_y") > 0).cast("int").alias("toxic"))
    found = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text")).where("_id IS NOT NULL")
    size = int(found.agg(F.sum(F.octet_length("text").cast("bigint")).alias("n")).first()["n"] or 0)
    parts = max(1, -(-size // part_bytes), min(LEAST_PARTS, -(-size // LEAST_BYTES)))
    order = F.xxhash64("_id")
    joined = found.repartition(parts, "_id").join(one.repartition(parts, "_id").hint("merge"), "_id").select("text", "toxic", order.alias("o"), "_id")
    rows = stage(joined.sortWithinPartitions("o", "_id", "text").select("text", "toxic", (F.pmod("o", F.lit(4)) < 3).alias("trains"), F.lit(True).alias("all")), "toxicity-rows")
    counts = {(r["trains"], r["toxic"]): r["n"] for r in rows.groupBy("trains", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        discard(rows)
        return None
    path = shared_folder(docs.sparkSession, "toxicity-model")
    toxic = sum(n for (_, y), n in counts.items() if y)
    model = Model(toxic / sum(counts.values()))
    if 0 < toxic < sum(counts.values()):
        apart = len(counts) == 4
        _fit_parts(rows, "trains" if apart else "all", path, parts, sample_bytes, counts[True, 1] / (counts[True, 0] + counts[True, 1]) if apart else model.prior)
        model.trained, model.levels = True, _thresholds(rows, F.lit(True) if not apart else ~F.col("trains"), path)
    discard(rows)
    files, base = filesystem(path)
    files.create_dir(base, recursive=True)
    with files.open_output_stream(f"{base}/head", compression=None) as out:
        pickle.dump((model.prior, model.trained, model.levels), out)
    return path


def _fit_parts(rows: DataFrame, column: str, path: str, parts: int, sample_bytes: int, share: float) -> None:
    """Write the start of the model and what each round makes of it, below `path`."""
    spark = rows.sparkSession
    files, names = _parquet_files(rows._staged_at)
    parts = min(parts, len(names))
    root = rows._staged_at
    names = [n.rsplit("/", 1)[1] for n in names]
    tasks = spark.range(0, parts, 1, parts)
    schema = "block long, part long, size long, body binary"

    def stored(part: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        files, base = filesystem(root)
        hasher = Hasher()
        for docs, y in _stored_texts(files, [f"{base}/{n}" for n in names[part::parts]], sample_bytes, column):
            yield [buckets(hasher, [d])[0] for d in docs], y

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (i for b in batches for i in b.column("id").to_pylist()):
            seen, n = np.zeros((TABLES, 2, BUCKETS), np.int32), 0
            for data, y in stored(part):
                _count(seen, data, y)
                n += len(y)
            blocks = ((b, seen[:, :, b * BLOCK : (b + 1) * BLOCK]) for b in range(BUCKETS // BLOCK))
            yield from _block_rows(part, n, ((b, body) for b, body in blocks if body.any()))

    def descend(batches: Iterator[pa.RecordBatch], before: int) -> Iterator[pa.RecordBatch]:
        for part in (i for b in batches for i in b.column("id").to_pylist()):
            model, n = _load_blocks(Model(0.0), path, before), 0
            descent = Descent(model)
            for data, y in stored(part):
                descent.run(data, y, EPOCHS)
                n += len(y)
            if n:
                dense = np.concatenate([p.reshape(-1) for p in (*descent.dense, np.array([model.shift]))])
                yield from _block_rows(part, n, iter([(-1, dense)]))
            for b in range(BUCKETS // BLOCK):
                at = slice(b * BLOCK, (b + 1) * BLOCK)
                changed = (descent.square[:, at] > 0).any(axis=2, keepdims=True)
                if changed.any():
                    yield from _block_rows(part, n, iter([(b, np.where(changed, model.embed[:, at], np.float32(np.nan)))]))

    _merged(tasks.mapInArrow(tidy(count), schema), _sum_of_counts(share), f"{path}/0")
    for r in range(ROUNDS):
        _merged(tasks.mapInArrow(tidy(lambda batches, r=r: descend(batches, r)), schema), _mean_of_parts, f"{path}/{r + 1}")


def _load_blocks(model: Model, path: str, last: int) -> Model:
    """Put the blocks of rounds up to `last` into the model, later ones over earlier."""
    for r in range(last + 1):
        files, names = _parquet_files(f"{path}/{r}")
        for name in names:
            with files.open_input_file(name) as source:
                for batch in pq.ParquetFile(source).iter_batches(8):
                    for block, body in zip(batch.column("block").to_pylist(), batch.column("body").to_pylist(), strict=True):
                        values = np.frombuffer(body, np.float32)
                        if block < 0:
                            for p in (*model.filters, model.bias, model.out):
                                p[...] = values[: p.size].reshape(p.shape)
                                values = values[p.size :]
                            model.shift = np.float32(values[0])
                        else:
                            kept = model.embed[:, block * BLOCK : (block + 1) * BLOCK]
                            new = values.reshape(kept.shape)
                            np.copyto(kept, new, where=~np.isnan(new))
    return model


def _thresholds(rows: DataFrame, use: Column, path: str) -> dict[str, float]:
    """Levels from counts, by language and step of the logit, of all rows that `use` picks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, model = Hasher(), _load_blocks(Model(0.0), path, ROUNDS)
        for whole in batches:
            for a in range(0, whole.num_rows, 500):
                batch = whole.slice(a, 500)
                docs = list(texts(batch))
                found = [pa.array([language(d.decode()) for d in docs], pa.string()), pa.array(model.raw(hasher, docs), pa.float64()), batch.column("toxic")]
                yield pa.RecordBatch.from_arrays(found, ["lang", "z", "toxic"])

    z = F.greatest(F.least(F.col("z"), F.lit(float(SPAN))), F.lit(-float(SPAN)))
    logits = rows.where(use).select("text", "toxic").mapInArrow(tidy(run), "lang string, z double, toxic int")
    steps = logits.groupBy("lang", F.floor(z * STEPS).alias("step")).agg(F.min("z").alias("low"), F.max("z").alias("high"), F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits"))
    got = steps.orderBy("lang", "step").collect()
    columns = [np.array([r[c] for r in got], np.float64) for c in ("step", "low", "high", "n", "hits")]
    return _calibrate(*columns, [r["lang"] for r in got])


def load(path: str | None) -> Model:
    """The model at a path of `fit`; without one, that of no labels."""
    model = Model(0.0)
    if path is None:
        return model
    files, base = filesystem(path)
    with files.open_input_stream(f"{base}/head", compression=None) as source:
        model.prior, model.trained, model.levels = pickle.load(source)
    return _load_blocks(model, path, ROUNDS) if model.trained else model


def score(docs: DataFrame, model: str | None, columns: list[str]) -> DataFrame:
    """`columns` of `docs` (which has `text`) and `score`, by the model at a path of `fit`."""
    kept = docs.select(*columns)
    schema = kept.schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, found = Hasher(), load(model)
        for whole in batches:
            for a in range(0, whole.num_rows, 500):
                batch = whole.slice(a, 500)
                got = found.scores(hasher, list(texts(batch, "_text")))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(got, pa.float64())], [*columns, "score"])

    return docs.select(*columns, F.col("text").alias("_text")).mapInArrow(tidy(run), schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered query's columns."""
    scored = score(docs, fit(docs, labels), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= AT).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, that the classifier does not reject."""
    rows = docs.select(F.struct("*").alias("_row"), "text")
    return score(rows, fit(docs, labels), ["_row"]).where(F.col("score") < AT).select("_row.*")
