"""Near-duplicate documents by ProbMinHash signatures, banding, and exact verification.

Shingles are `SHINGLE` consecutive words (a shorter text is one shingle), weighted by their
number of occurrences. In a ProbMinHash signature every shingle emits a Poisson process of
arrivals, at a rate proportional to its weight, each striking a random register; a register
keeps the shingle that struck it first. Two signatures agree in a register with the
probability Jaccard similarity of the weighted shingles. A shingle stops once its next
arrival comes after every register's first; arrivals are drawn in growing blocks, for all
documents of a piece at once.

Repeated shingles can part the weighted similarity from that of the sets, so a text with
some has a second signature with all weights one; other texts have one that serves as both.

`BANDS` bands of `ROWS` registers bring pairs together: a pair at similarity 0.8 shares a
band with probability 1 - (1 - 0.8**5)**24 = 0.9999, whichever of the two similarities it
is: a text stands in the buckets of both its signatures. Then:

1. Exact copies (equal word sequences) are one node, named by their smallest id.
2. Every node of a band's bucket is paired with the bucket's leader, the node that shares
   buckets with most nodes (of a group of copies, likely what they were made from), so a
   bucket of n nodes gives n - 1 pairs. Each node is verified against the leader it shares
   most bands with; components of these links follow.
3. Buckets that hold several components have the pairs between them compared as well: by
   signature (registers agreeing within five standard deviations of the threshold), in the
   first band that a pair shares, by `WIDE` further registers of eight bits (all registers
   within four deviations), with either kind of signature, and then exactly. Large buckets are cut into pairs of
   blocks for separate tasks. Nothing is capped: pairs inside a component need no look.

Verification is exact: the probability Jaccard similarity of the counts or the Jaccard
similarity of the sets, whichever is larger (they are equal without repeated shingles).
Classes are the connected components of verified links.

Defined cases: null, empty and wordless texts are alone in their class; rows that share an
id are in one class; a row without id is alone, with a null class, and is kept; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwise.llm.common import attach_group_facts, connected_components, discard, stage, texts, tidy
from dockwise.llm.suffix_dedup import Hasher, _mix

SHINGLE = 5
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
WIDE = 512  # further registers, for pairs of a bucket
BLOCK = 2048
SALT_ROWS = 256
KNOWN = 2_000_000  # shingles that a task keeps at hand
PIECE = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True


def word_bytes(data: np.ndarray) -> np.ndarray:
    """Lower-cased (A-Z) words, digits, letters and non-ASCII, each followed by one space."""
    low = LOWER[data]
    word = IS_WORD[low]
    keep = word.copy()
    keep[1:] |= word[:-1]
    return np.where(word, low, 32)[keep].astype(np.uint8)


def shingles(hasher: Hasher, docs: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Hash and document number of every shingle, and the documents' word sequences."""
    plain = [word_bytes(np.frombuffer(d + b" ", np.uint8)) for d in docs]
    size = np.array([len(p) for p in plain], np.int64)
    data = np.concatenate(plain) if plain else np.zeros(0, np.uint8)
    hasher.load(data)
    ends = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    doc = np.searchsorted(np.cumsum(size), starts, "right")
    n = np.bincount(doc, minlength=len(docs))
    first = np.cumsum(n) - n
    # The shingle of word i ends with word i + SHINGLE - 1, or with a short text's last word.
    last = np.minimum(np.arange(len(starts)) + SHINGLE - 1, (first + n - 1)[doc])
    full = (np.arange(len(starts)) == first[doc]) | (np.arange(len(starts)) + SHINGLE <= (first + n)[doc])
    i = np.flatnonzero(full)
    return hasher.of(starts[i], ends[last[i]]), doc[i], [p.tobytes() for p in plain]


def weighted(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles per document in order, and their counts."""
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return hashes[at], doc[at], np.diff(np.append(at, len(hashes)))


def signatures(hashes: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash registers (32 bits of the winning shingle) per document."""
    first = np.full(n_docs * registers, np.inf)
    winner = np.zeros(n_docs * registers, np.uint32)
    name = (hashes >> np.uint64(32)).astype(np.uint32)
    active, time = np.arange(len(hashes)), np.zeros(len(hashes))
    drawn, block = 0, 1
    while len(active):
        number = np.arange(drawn + 1, drawn + block + 1, dtype=np.uint64)
        seed = hashes[active][:, None] + number * np.uint64(0x9E3779B97F4A7C15)
        bits = _mix(seed)
        gap = -np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight[active][:, None]
        arrival = time[:, None] + np.cumsum(gap, axis=1)
        register = (_mix(bits ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(33)).astype(np.int64) % registers
        place = (doc[active][:, None] * registers + register).reshape(-1)
        flat = arrival.reshape(-1)
        better = flat < first[place]
        place, flat = place[better], flat[better]
        np.minimum.at(first, place, flat)
        won = flat == first[place]
        winner[place[won]] = np.repeat(name[active], block)[better][won]
        time = arrival[:, -1]
        on = time < first.reshape(n_docs, registers).max(axis=1)[doc[active]]
        active, time = active[on], time[on]
        drawn, block = drawn + block, min(block * 2, 64)
    return winner.reshape(n_docs, registers)


def both_signatures(hashes: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, registers: int = REGISTERS) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Signatures by count of all documents, and by set of those with repeated shingles."""
    again = np.unique(doc[weight > 1])
    of = np.isin(doc, again)
    flat = signatures(hashes[of], np.searchsorted(again, doc[of]), np.ones(int(of.sum()), np.int64), len(again), registers) if len(again) else []
    return signatures(hashes, doc, weight, n_docs, registers), dict(zip(again.tolist(), flat, strict=True))


def wide_signatures(bodies: DataFrame) -> DataFrame:
    """`(node, wide, flat_wide)`: `WIDE` further registers of other hashes, eight bits each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            out, flat = [], []
            for text in texts(batch):
                hashes, doc, weight = weighted(*shingles(hasher, [text])[:2])
                sig, sets = both_signatures(_mix(hashes ^ np.uint64(0x5DEECE66D)), doc, weight, 1, WIDE)
                out.append(sig[0].astype(np.uint8).tobytes())
                flat.append(sets[0].astype(np.uint8).tobytes() if sets else b"")
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.binary()), pa.array(flat, pa.binary())], ["node", "wide", "flat_wide"])

    return bodies.select("node", "text").mapInArrow(run, "node long, wide binary, flat_wide binary")


def signed(docs: DataFrame) -> DataFrame:
    """`(node, w1, w2, sig, flat)`: id, hash of the word sequence and signatures of texts with
    words; `flat`, by set, is empty where it equals `sig`, by count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()

        def piece(ids: list[int], bodies: list[bytes]) -> pa.RecordBatch:
            hashes, doc, plain = shingles(hasher, bodies)
            sig, flat = both_signatures(*weighted(hashes, doc), len(bodies))
            has = [i for i, p in enumerate(plain) if p]
            w = np.frombuffer(b"".join(xxhash.xxh3_128_digest(plain[i]) for i in has), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[i] for i in has], pa.int64()), pa.array(w[:, 0].copy()), pa.array(w[:, 1].copy()), pa.array([sig[i].tobytes() for i in has], pa.binary()),
                    pa.array([flat[i].tobytes() if i in flat else b"" for i in has], pa.binary()),
                ],
                ["node", "w1", "w2", "sig", "flat"],
            )

        for batch in batches:
            ids, bodies, held = [], [], 0
            for i, text in zip(batch.column("node").to_pylist(), texts(batch), strict=True):
                ids.append(i)
                bodies.append(text)
                held += len(text)
                if held > PIECE:
                    yield piece(ids, bodies)
                    ids, bodies, held = [], [], 0
            if ids:
                yield piece(ids, bodies)

    return docs.where("node IS NOT NULL").select("node", "text").mapInArrow(tidy(run), "node long, w1 long, w2 long, sig binary, flat binary")


def _regs(column: pa.Array, dtype: type = np.uint32, registers: int = REGISTERS, otherwise: pa.Array | None = None) -> np.ndarray:
    """Registers of every row; those of `otherwise` where a row has none."""
    rows = [x.as_py() for x in column]
    if otherwise is not None:
        rows = [x or y.as_py() for x, y in zip(rows, otherwise, strict=True)]
    return np.frombuffer(b"".join(rows), dtype).reshape(-1, registers)


def band_rows(nodes: DataFrame) -> DataFrame:
    """`(band, bucket, node)`: a row per node and band, two where its signatures differ there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = np.array([0x9E3779B97F4A7C15 * (2 * r + 1) & (1 << 64) - 1 for r in range(ROWS)], np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue

            def bucket(sig: np.ndarray) -> np.ndarray:
                return _mix((_mix(sig.reshape(-1, BANDS, ROWS).astype(np.uint64) + np.uint64(1)) * power).sum(axis=2)).view(np.int64).reshape(-1)

            band = np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)
            node = np.repeat(batch.column("node").to_numpy(), BANDS)
            one = bucket(_regs(batch.column("sig")))
            two = bucket(_regs(batch.column("flat"), otherwise=batch.column("sig")))
            new = one != two
            yield pa.RecordBatch.from_arrays([pa.array(np.append(x, y[new])) for x, y in ((band, band), (one, two), (node, node))], ["band", "bucket", "node"])

    return nodes.select("node", "sig", "flat").mapInArrow(run, "band int, bucket long, node long")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of the probability Jaccard similarity and the Jaccard similarity."""
    (ha, wa), (hb, wb) = a, b
    both, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    plain = len(both) / (len(ha) + len(hb) - len(both))
    if wa.max() == 1 and wb.max() == 1:
        return plain
    x, y = wa[ia].astype(float), wb[ib].astype(float)
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    ratios, n = np.unique(np.stack([x, y]), axis=1, return_counts=True)
    # Shared shingles of equal counts have equal terms.
    total = sum(c / (np.maximum(x / p, y / q).sum() + only_a / p + only_b / q) for (p, q), c in zip(ratios.T, n, strict=True))
    return max(plain, float(total))


def verified(pairs: DataFrame, bodies: DataFrame, threshold: float) -> DataFrame:
    """The pairs `(a, b)` whose texts reach the threshold. `b` may be in very many pairs: its
    text is dealt out to one join key per `SALT_ROWS` of them."""
    uses = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("uses"))
    known = attach_group_facts(pairs, uses, ["b"], "uses", "a")
    salts = F.ceil(F.col("uses") / SALT_ROWS).cast("int")
    salted = known.withColumn("salt", F.pmod(F.xxhash64("a"), salts).cast("int")).select("a", "b", "salt")
    right = bodies.join(uses, F.col("node") == F.col("b")).select(
        "b", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.col("text").alias("tb")
    )
    left = salted.join(bodies.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    both = left.join(right, ["b", "salt"]).select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, known, held = Hasher(), {}, 0

        def of(node: int, text: bytes) -> tuple[np.ndarray, np.ndarray]:
            nonlocal held
            if node not in known:
                found = weighted(*shingles(hasher, [text])[:2])[::2]
                held += len(found[0])
                if held > KNOWN:
                    known.clear()
                    held = len(found[0])
                known[node] = found
            return known[node]

        for batch in batches:
            keep = []
            ids = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)
            for (a, b), ta, tb in zip(ids, texts(batch, "ta"), texts(batch, "tb"), strict=True):
                keep.append(similarity(of(a, ta), of(b, tb)) >= threshold)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(tidy(run), "a long, b long")


def _bucket_pairs(threshold: float):
    """Cross-component pairs of a bucket's block pair, by signature, in their first band."""
    bound = lambda n, deviations: n * threshold - deviations * (n * threshold * (1 - threshold)) ** 0.5
    least, least_of_all = bound(REGISTERS, 5), bound(REGISTERS + WIDE, 4)

    def pairs(band: int, node: np.ndarray, comp: np.ndarray, kinds: list[tuple[np.ndarray, np.ndarray]], side: np.ndarray, cross: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in range(len(node) - 1):
            j = np.arange(i + 1, len(node))
            j = j[(comp[j] != comp[i]) & ((side[j] != side[i]) if cross else True)]
            for some in np.array_split(j, max(1, len(j) // 4096)):
                ok, met = np.zeros(len(some), bool), np.zeros(len(some), bool)
                for sig, wide in kinds:  # one kind of signature is enough
                    same = sig[some] == sig[i]
                    agree = same.sum(axis=1)
                    near = np.flatnonzero(agree >= least)
                    ok[near] |= agree[near] + (wide[some[near]] == wide[i]).sum(axis=1) >= least_of_all
                    if band:
                        met |= same.reshape(-1, BANDS, ROWS).all(axis=2)[:, :band].any(axis=1)
                ok &= ~met
                if ok.any():
                    yield np.full(int(ok.sum()), node[i]), node[some[ok]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["band", "bucket", "lo", "hi"]
        rest: pa.Table | None = None

        def groups(table: pa.Table) -> Iterator[pa.RecordBatch]:
            keys = np.stack([table.column(c).to_numpy() for c in names])
            edges = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [table.num_rows]])
            node, comp, side = (table.column(c).to_numpy() for c in ("node", "comp", "side"))
            kinds = [(_regs(table.column("sig")), _regs(table.column("wide"), np.uint8, WIDE))]
            if any(len(x.as_py()) for x in table.column("flat")):
                kinds.append((_regs(table.column("flat"), otherwise=table.column("sig")), _regs(table.column("flat_wide"), np.uint8, WIDE, table.column("wide"))))
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                for a, b in pairs(int(keys[0, s]), node[s:e], comp[s:e], [(x[s:e], y[s:e]) for x, y in kinds], side[s:e], keys[2, s] != keys[3, s]):
                    yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            keys = np.stack([table.column(c).to_numpy() for c in names])
            change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))
            cut = int(change[-1]) + 1 if len(change) else 0
            if cut:
                yield from groups(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None and rest.num_rows:
            yield from groups(rest)

    return run


def classes(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id") -> DataFrame:
    """Every row's id, class and whether it is the one that stays: `node, class_id, kept`.

    The class is named by its smallest id; of rows sharing that id all are marked.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("node"), "text")
    sigs = stage(signed(rows), "near-signatures")
    copies = stage(
        sigs.groupBy("w1", "w2").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("n")), "near-copies"
    )
    reps = copies.select("w1", "w2", F.col("rep").alias("node"))
    nodes = stage(sigs.join(reps, ["w1", "w2", "node"], "left_semi").dropDuplicates(["w1", "w2", "node"]).select("node", "sig", "flat"), "near-nodes")
    member = stage(
        attach_group_facts(sigs.select("node", "w1", "w2"), copies, ["w1", "w2"], "n", "node").select("node", "rep").distinct(), "near-members"
    )
    discard(sigs, copies)
    counts = stage(band_rows(nodes).groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("least")).where("n > 1"), "near-buckets")
    met = stage(attach_group_facts(band_rows(nodes), counts, ["band", "bucket"], "n", "node").where("n IS NOT NULL").drop("least"), "near-met")
    # The text that copies were made from shares most buckets with most nodes.
    drawn = met.groupBy("node").agg(F.sum("n").alias("drawn"))
    ranked = met.join(drawn, "node")
    leaders = ranked.groupBy("band", "bucket").agg(F.max(F.struct("drawn", (-F.col("node")).alias("minus"))).alias("top"), F.max("n").alias("n"))
    leaders = stage(leaders.select("band", "bucket", "n", (-F.col("top.minus")).alias("leader")), "near-leaders")
    shared = stage(attach_group_facts(met.drop("n"), leaders, ["band", "bucket"], "n", "node"), "near-shared")
    discard(counts, met, leaders)
    ledger = shared.where("leader <> node").groupBy(F.col("node").alias("a"), F.col("leader").alias("b")).agg(F.count(F.lit(1)).alias("bands"))
    needed = shared.select("node").distinct()
    # The text of a node: any of the rows with its id; ids are unique in a clean corpus.
    # Texts are shuffled to their nodes at every size, so that cost grows with the input alone.
    bodies = stage(rows.join(needed.hint("shuffle_hash"), "node").dropDuplicates(["node"]), "near-bodies")

    best = F.max_by(F.col("b"), F.struct(F.col("bands"), -F.col("b")))
    first = stage(ledger.groupBy("a").agg(best.alias("b")), "near-first")
    links = stage(verified(first, bodies, threshold), "near-links")
    found = connected_components(links, "a", "b", "near-components")
    placed = shared.select("band", "bucket", "n", "node").join(found, "node", "left").withColumn("comp", F.coalesce("component", "node"))
    placed = stage(placed.drop("component"), "near-placed")
    several = placed.groupBy("band", "bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.max("n").alias("n"))
    several = stage(several.where("low < high").select("band", "bucket", "n"), "near-several")
    looked = attach_group_facts(placed.drop("n"), several, ["band", "bucket"], "n", "node").where("n IS NOT NULL")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = looked.withColumns({"blocks": blocks, "side": F.pmod(F.xxhash64("node"), blocks).cast("int")})
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    broad = wide_signatures(bodies.join(looked.select("node").distinct(), "node", "left_semi"))
    sigs = stage(nodes.join(broad, "node"), "near-wide")
    dealt = dealt.join(sigs, "node").select("band", "bucket", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", "node", "comp", "sig", "wide", "flat", "flat_wide")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartition(parts, "band", "bucket", "lo", "hi").sortWithinPartitions("band", "bucket", "lo", "hi")
    more = ordered.mapInArrow(tidy(_bucket_pairs(threshold)), "a long, b long").distinct()
    tried = first.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    more = stage(more.join(tried, ["a", "b"], "left_anti"), "near-more")
    links = links.union(verified(more, bodies, threshold))
    # Copies follow their representative; an id in two copy groups joins them.
    ties = member.where("node <> rep").select(F.col("node").alias("a"), F.col("rep").alias("b"))
    final = connected_components(links.union(ties), "a", "b", "near-classes")
    return (
        docs.select(F.col(id_col).cast("bigint").alias("node"))
        .join(final, "node", "left")
        .select("node", F.coalesce("component", "node").alias("class_id"))
        .withColumn("kept", F.coalesce(F.col("node") == F.col("class_id"), F.lit(True)))
    )


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns."""
    return classes(docs).select(F.col("node").alias("doc_id"), "class_id", "kept")


def one_of_each(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The documents, all columns, that stay: one row of each class.

    Rows are told apart by id; those without an id, or whose id occurs again, by id and text (a
    number of at least 2**62 hashed from both), so that unlike rows with one id are documents of
    their own. Of rows equal in id and text one stays, of a class the smallest number. Ids of
    other rows are below 2**62.
    """
    long_id = F.col("doc_id").cast("bigint")
    again = docs.groupBy(long_id.alias("_node")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 AND _node IS NOT NULL")
    rows = docs.select(F.struct("*").alias("row"), long_id.alias("_node"), "text")
    told = attach_group_facts(rows, stage(again, "near-repeated-ids"), ["_node"], "_n", "text")
    shared = F.col("_node").isNull() | F.col("_n").isNotNull()
    made = F.shiftrightunsigned(F.xxhash64("_node", "text"), 2) + (1 << 62)
    keyed = told.select("row", "text", shared.alias("shared"), F.when(shared, made).otherwise(F.col("_node")).alias("key"))
    found = classes(keyed, threshold, "key")
    kept = keyed.join(found.where("kept").select(F.col("node").alias("key")).distinct(), "key", "left_semi")
    # Rows equal in id and text: the one with the smallest hash of all columns.
    one = kept.where("shared").groupBy("key").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return kept.where("NOT shared").select("row.*").union(one.select("row.*"))
