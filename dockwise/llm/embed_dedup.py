"""Embedding near-dedup by counting collisions of one-dimensional projections.

Vectors are normalized in double precision. Every vector has a sketch: `SKETCH` random
projections, quantized. Two vectors collide in a projection if each lies in a window
centred at the other; the window is twice the distance of the threshold, so a pair at the
threshold collides with probability 0.954, and `NEED` of `SKETCH` collisions keep 99.99 % of
such pairs, nearly all closer ones, and about one in a thousand unrelated ones.

Windows over all vectors would meet a fixed share of all pairs, so projections are sorted
within cells: each of many tables deals vectors into the cells of a randomly shifted grid over
a few further projections. In every cell each of the `SKETCH` projections is sorted, a window
is opened around every entry, and each pair found in it gets one more count; no single
projection can rule a pair out. The number of tables follows from the chance of sharing a cell
at the threshold, for `recall`; the number of grid projections grows with the logarithm of the
number of vectors, so that cells stay small. Cells over `CELL` entries are cut into pairs of
blocks that separate tasks compare. Pairs passing the count are verified by exact cosine.

Copies. Vectors within half the threshold's angle of one leader are all linked to each
other, by the triangle inequality; such a ball is one entry of a cell, however many copies it
has, and its inner links are counted without being listed. Leaders are the smallest ids of
cells of a few tables; a vector joins the smallest leader that it verifies against. A pair
of balls is compared by centres and radii: certainly linked, certainly not, or else its
members are compared.

Defined cases: null, zero, or non-finite vectors, and vectors with null components, link
with nothing; vectors of different lengths do not link; repeated ids count as one vector
(of differing ones, that with the smallest hash) and each row gets the same result; a row
without id has no links, no component, and is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwise.llm.common import attach_group_facts, connected_components, stage

SKETCH, NEED, SCALE = 32, 24, 32
WIDTH = 1.6  # of grid cells, in standard deviations of a unit vector's projection
LEADER_TABLES, LEADER_GRID = 12, 8
CELL = 4096
COUNTERS, PAIRS = 1 << 22, 500_000  # held at a time by a task
SEED = 20260101


def shared_cell(distance: float, width: float = WIDTH) -> float:
    """Chance that two vectors at `distance` share one randomly shifted grid interval."""
    x = (np.arange(20_000) + 0.5) / 20_000 * width
    density = np.exp(-(x**2) / (2 * distance**2)) * 2 / (distance * math.sqrt(2 * math.pi))
    return float(np.sum((1 - x / width) * density) * width / 20_000)


def plan_tables(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Grid projections and tables for `n` vectors."""
    grid = max(10, round(math.log2(max(n, 1) / 50)))
    hit = shared_cell(math.sqrt(2 - 2 * threshold)) ** grid
    return grid, math.ceil(math.log(1 - recall) / math.log(1 - hit))


def directions(dim: int, count: int, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Random directions and grid shifts, the same in every task."""
    rng = np.random.default_rng([SEED, dim, part])
    return rng.standard_normal((dim, count)), rng.uniform(0, WIDTH, count)


def prepare(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """`(vec, v, sketch)` of every usable vector; `v` is normalized, in doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vs, sketches = [], [], []
            for i, row in zip(batch.column("vec").to_pylist(), batch.column("x"), strict=True):
                x = np.array(row.values.to_numpy(zero_copy_only=False), np.float64)
                top = np.abs(x).max() if len(x) else 0.0
                if not np.isfinite(top) or top == 0:
                    continue
                x = x / top  # no overflow of the squares
                x /= math.sqrt(float(x @ x))
                if len(x) not in mats:
                    mats[len(x)] = directions(len(x), SKETCH, 0)[0]
                ids.append(i)
                vs.append(x.tobytes())
                sketches.append(np.clip(np.rint(x @ mats[len(x)] * SCALE), -127, 127).astype(np.int8).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vs, pa.binary()), pa.array(sketches, pa.binary())], ["vec", "v", "sketch"])

    mats: dict[int, np.ndarray] = {}
    x = F.col(vector_col).cast("array<double>")
    usable = vectors.select(F.col(id_col).cast("bigint").alias("vec"), x.alias("x")).where(
        F.col("vec").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", lambda c: c.isNull() | F.isnan(c))
    )
    # One vector per id; which one does not depend on the order of rows.
    one = usable.groupBy("vec").agg(F.min_by("x", F.xxhash64("x")).alias("x"))
    return one.mapInArrow(run, "vec long, v binary, sketch binary")


def cells(rows: DataFrame, keep: list[str], tables: int, grid: int, part: int) -> DataFrame:
    """One row per vector and table: `keep`, the table `t` and the grid cell `cell`."""
    kept = rows.select(*keep, "v")
    schema = ", ".join(f"{c} {kept.schema[c].dataType.simpleString()}" for c in keep) + ", t int, cell long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixers = np.random.default_rng([SEED, part]).integers(1, 1 << 62, grid, dtype=np.int64) | 1
        made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for whole in batches:
            for a in range(0, whole.num_rows, 500):
                batch = whole.slice(a, 500)
                raw = [x.as_py() for x in batch.column("v")]
                out = np.empty((len(raw), tables), np.int64)
                lengths = np.array([len(x) // 8 for x in raw])
                for dim in np.unique(lengths):
                    if dim not in made:
                        made[dim] = directions(int(dim), tables * grid, part)
                    which = np.flatnonzero(lengths == dim)
                    x = np.frombuffer(b"".join(raw[i] for i in which), np.float64).reshape(-1, dim)
                    steps = np.floor((x @ made[dim][0] + made[dim][1]) / WIDTH).astype(np.int64)
                    with np.errstate(over="ignore"):
                        out[which] = (steps.reshape(len(which), tables, grid) * mixers).sum(axis=2) * 1_000_003 + dim
                take = pa.array(np.repeat(np.arange(len(raw)), tables))
                cols = [batch.column(c).take(take) for c in keep]
                t = np.tile(np.arange(tables, dtype=np.int32), len(raw))
                yield pa.RecordBatch.from_arrays([*cols, pa.array(t), pa.array(out.reshape(-1))], [*keep, "t", "cell"])

    return kept.mapInArrow(run, schema)


def _matrix(column: pa.Array, dtype: type) -> np.ndarray:
    rows = [x.as_py() for x in column]
    return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1)


def _dots(column_a: pa.Array, column_b: pa.Array) -> np.ndarray:
    out = np.empty(len(column_a))
    for i, (a, b) in enumerate(zip(column_a, column_b, strict=True)):
        x, y = np.frombuffer(a.as_py()), np.frombuffer(b.as_py())
        out[i] = x @ y if len(x) == len(y) else -2.0
    return out


def with_cosine(pairs: DataFrame, prep: DataFrame, a: str, b: str) -> DataFrame:
    """Adds `cos` to pairs of ids; `b` may be hot."""
    facts = pairs.groupBy(b).agg(F.count(F.lit(1)).alias("_n")).join(
        prep.select(F.col("vec").alias(b), F.col("v").alias("_vb")), b
    )
    right = attach_group_facts(pairs, facts, [b], "_n", a).drop("_n")
    both = right.join(prep.select(F.col("vec").alias(a), F.col("v").alias("_va")), a)
    kept = pairs.columns
    schema = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in kept) + ", cos double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cos = _dots(batch.column("_va"), batch.column("_vb"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(cos)], [*kept, "cos"])

    return both.select(*kept, "_va", "_vb").mapInArrow(run, schema)


def balls(prep: DataFrame, angle: float) -> DataFrame:
    """`(vec, ball, turn)`: each vector's leader and its angle to it; most lead themselves."""
    half = angle / 2 - 1e-9
    rows = stage(cells(prep, ["vec", "sketch"], LEADER_TABLES, LEADER_GRID, 1), "embed-leader-cells")
    facts = rows.groupBy("t", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec").alias("leader"), F.min_by("sketch", "vec").alias("lead")
    ).where("n > 1")
    seen = attach_group_facts(rows, facts, ["t", "cell"], "n", "vec").where("leader < vec")
    # Sketches estimate the distance to a fifth; far leaders need no verification.
    far = (2 * math.sin(half / 2) * 1.8) ** 2

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = (_matrix(batch.column("sketch"), np.int8).astype(np.float32) - _matrix(batch.column("lead"), np.int8)) / SCALE
                yield batch.select(["vec", "leader"]).filter(pa.array((d**2).mean(axis=1) <= far))

    pairs = stage(seen.mapInArrow(near, "vec long, leader long").distinct(), "embed-leader-pairs")
    close = with_cosine(pairs, prep, "vec", "leader").where(F.col("cos") >= math.cos(half))
    joined = stage(close.groupBy("vec").agg(F.min("leader").alias("leader"), F.min_by("cos", "leader").alias("cos")), "embed-joined")
    # A leader that follows another one leads nobody.
    leads = joined.groupBy("leader").agg(F.count(F.lit(1)).alias("n"))
    free = leads.join(joined.select(F.col("vec").alias("leader")), "leader", "left_anti").withColumn("ball", F.col("leader"))
    member = attach_group_facts(joined, free, ["leader"], "n", "vec").where("ball IS NOT NULL").select(
        "vec", "ball", F.acos(F.least(F.col("cos"), F.lit(1.0))).alias("turn")
    )
    return stage(
        prep.select("vec").join(member, "vec", "left").select("vec", F.coalesce("ball", "vec").alias("ball"), F.coalesce("turn", F.lit(0.0)).alias("turn")),
        "embed-balls",
    )


def _collisions(threshold_angle: float):
    """Pairs of entries of one cell that collide in enough projections."""

    def windows(r: np.ndarray) -> np.ndarray:
        distance = 2 * np.sin(np.minimum(threshold_angle + r, math.pi) / 2)
        return np.ceil(2 * distance * SCALE).astype(np.int64) + 1

    def count(cell: np.ndarray, ball: np.ndarray, sketch: np.ndarray, r: np.ndarray, side: np.ndarray, cross: np.ndarray) -> np.ndarray:
        """Candidates among entries that are grouped by `cell` (0, 1, ...); `cross` tells, per
        entry, that the cell's pairs are those of one side with the other."""
        sizes = np.bincount(cell)
        first = np.cumsum(sizes) - sizes
        base = np.concatenate([[0], np.cumsum(sizes * sizes)])  # a counter for each pair of a cell
        row = base[cell] + (np.arange(len(cell)) - first[cell]) * sizes[cell] - first[cell]
        counters = np.zeros(base[-1], np.uint8)
        widest = np.maximum.reduceat(r, first)
        reach, plain = windows(r + widest[cell]), not widest.any()
        for m in range(SKETCH):
            # One sort for all cells: they lie further apart than any window reaches.
            value = cell * 4096 + sketch[:, m]
            order = np.argsort(value, kind="stable")
            along = value[order]
            # Windows are symmetric: the half above each entry has every pair once.
            n = np.searchsorted(along, along + reach[order], "right") - np.arange(len(along)) - 1
            cuts = np.unique(np.searchsorted(np.cumsum(n), np.arange(0, n.sum() + 1, PAIRS)))
            for a, b in zip(cuts, np.append(cuts[1:], len(n)), strict=True):
                i = np.repeat(np.arange(a, b), n[a:b])
                j = np.arange(len(i)) - np.repeat(np.cumsum(n[a:b]) - n[a:b], n[a:b]) + i + 1
                x, y = order[i], order[j]
                if not plain:  # balls: the window of this very pair
                    on = along[j] - along[i] <= windows(r[x] + r[y])
                    x, y = x[on], y[on]
                counters[row[np.minimum(x, y)] + np.maximum(x, y)] += 1
        slot = np.flatnonzero(counters >= NEED)
        at = np.searchsorted(base, slot, "right") - 1
        x, y = (part + first[at] for part in np.divmod(slot - base[at], sizes[at]))
        on = (ball[x] != ball[y]) & ~(cross[x] & (side[x] == side[y]))
        x, y = ball[x[on]], ball[y[on]]
        return np.stack([np.minimum(x, y), np.maximum(x, y)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["t", "cell", "lo", "hi"]
        rest: pa.Table | None = None

        def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
            keys = np.stack([table.column(c).to_numpy() for c in names])
            edges = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [table.num_rows]])
            sizes = np.diff(edges)
            cell = np.repeat(np.arange(len(sizes)), sizes)
            ball, r, side = (table.column(c).to_numpy() for c in ("ball", "r", "side"))
            cross = keys[2] != keys[3]
            sketch = _matrix(table.column("sketch").combine_chunks(), np.int8)
            # Cells are counted together as long as they have few counters.
            share = (np.cumsum(sizes * sizes) - 1) // COUNTERS
            of_row = np.where(sizes > 1, share, -1)[cell]
            for part in np.unique(share[sizes > 1]):
                on = np.flatnonzero(of_row == part)
                _, numbered = np.unique(cell[on], return_inverse=True)
                got = np.unique(count(numbered, ball[on], sketch[on], r[on], side[on], cross[on]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(got[0]), pa.array(got[1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            # The last cell may go on in the next batch.
            keys = np.stack([table.column(c).to_numpy() for c in names])
            change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))
            cut = int(change[-1]) + 1 if len(change) else 0
            if cut:
                yield from pairs(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None and rest.num_rows:
            yield from pairs(rest)

    return run


def candidate_pairs(prep: DataFrame, member: DataFrame, facts: DataFrame, angle: float, threshold: float, recall: float) -> DataFrame:
    """Distinct pairs `a < b` of balls with members in a common cell and enough collisions."""
    spark = prep.sparkSession
    grid, tables = plan_tables(prep.count(), threshold, recall)
    # Balls of one vector are their own entries; a larger ball enters each cell once.
    single = prep.join(facts.where("size = 1").select(F.col("ball").alias("vec")), "vec", "left_semi")
    alone = cells(single, ["vec", "sketch"], tables, grid, 2).select(
        "t", "cell", F.col("vec").alias("ball"), "sketch", F.lit(0.0).alias("r")
    )
    large = facts.where("size > 1")
    in_large = attach_group_facts(member, large.select("ball", "size"), ["ball"], "size", "vec").where("size IS NOT NULL")
    spread = cells(prep.join(in_large.select("vec", "ball"), "vec"), ["ball"], tables, grid, 2).select("t", "cell", "ball").distinct()
    centre = large.select("ball", "r").join(prep.select(F.col("vec").alias("ball"), "sketch"), "ball")
    together = spread.join(centre, "ball").select("t", "cell", "ball", "sketch", "r")
    entries = stage(alone.union(together), "embed-entries")
    counts = entries.groupBy("t", "cell").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > CELL)
    sized = attach_group_facts(entries, counts, ["t", "cell"], "m", "ball")
    blocks = F.coalesce(F.ceil(F.col("m") / CELL), F.lit(1)).cast("int")
    side = F.pmod(F.xxhash64("ball"), blocks).cast("int")
    dealt = sized.withColumns({"_blocks": blocks, "side": side}).withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    keyed = dealt.select("t", "cell", F.least("side", "_o").alias("lo"), F.greatest("side", "_o").alias("hi"), "side", "ball", "sketch", "r")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartition(n, "t", "cell", "lo", "hi").sortWithinPartitions("t", "cell", "lo", "hi")
    return stage(ordered.mapInArrow(_collisions(angle), "a long, b long").distinct(), "embed-candidates")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.999, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Every row's id, number of links and component: `vec_id, n_links, component_id, kept`."""
    angle = math.acos(threshold)
    prep = stage(prepare(vectors, id_col, vector_col), "embed-prepared")
    member = balls(prep, angle)
    facts = stage(member.groupBy("ball").agg(F.count(F.lit(1)).alias("size"), F.max("turn").alias("r")), "embed-ball-facts")
    found = candidate_pairs(prep, member, facts, angle, threshold, recall)
    side = lambda c: facts.select(F.col("ball").alias(c), F.col("size").alias(f"s{c}"), F.col("r").alias(f"r{c}"))
    judged = with_cosine(found, prep, "a", "b").join(side("a"), "a").join(side("b"), "b")
    turn = F.acos(F.greatest(F.least(F.col("cos"), F.lit(1.0)), F.lit(-1.0)))
    plain = (F.col("sa") == 1) & (F.col("sb") == 1)
    sure = F.when(plain, F.col("cos") >= threshold).otherwise(turn + F.col("ra") + F.col("rb") <= angle - 1e-9)
    possible = ~plain & (turn - F.col("ra") - F.col("rb") <= angle + 1e-9)
    judged = stage(judged.withColumns({"sure": sure, "possible": possible}).where("sure OR possible"), "embed-judged")
    linked = judged.where("sure")
    # Unclear pairs of balls: their members are compared, an ordinary join on the ball.
    unclear = judged.where("NOT sure").select("a", "b")
    left = member.select(F.col("ball").alias("a"), F.col("vec").alias("x"))
    right = member.select(F.col("ball").alias("b"), F.col("vec").alias("y"))
    across = unclear.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    pairs = stage(with_cosine(across, prep, "x", "y").where(F.col("cos") >= threshold), "embed-member-links")
    per_ball = linked.select(F.col("a").alias("ball"), F.col("sb").alias("n")).union(linked.select("b", "sa")).groupBy("ball").agg(F.sum("n").alias("outer"))
    per_vec = pairs.select(F.col("x").alias("vec")).union(pairs.select("y")).groupBy("vec").agg(F.count(F.lit(1)).alias("single"))
    component = connected_components(linked.select("a", "b").union(pairs.select("a", "b")).distinct(), "a", "b", "embed-components")
    about = (
        facts.join(per_ball, "ball", "left")
        .join(component.withColumnRenamed("node", "ball"), "ball", "left")
        .select("ball", "size", (F.col("size") - 1 + F.coalesce("outer", F.lit(0))).alias("inner"), F.coalesce("component", "ball").alias("component"))
    )
    rowed = attach_group_facts(member.select("vec", "ball"), about, ["ball"], "size", "vec").join(per_vec, "vec", "left")
    result = rowed.select("vec", (F.col("inner") + F.coalesce("single", F.lit(0))).alias("n_links"), "component")
    ids = vectors.select(F.col(id_col).cast("bigint").alias("vec"))
    return ids.join(result, "vec", "left").select(
        F.col("vec").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component", "vec").alias("component_id"),
        F.coalesce(F.coalesce("component", "vec") == F.col("vec"), F.lit(True)).alias("kept"),
    )
