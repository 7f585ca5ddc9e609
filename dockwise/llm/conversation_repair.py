"""Conversation structure repair: generalised LR parsing with weighted edits.

A conversation should read `(s?(ua)+)?` in the initials of its roles: nothing, or an optional
system row and pairs of user and assistant rows. Faulty conversations are parsed with the
grammar's LR tables, while every row may be kept, re-roled or deleted and empty user and assistant
rows may be inserted, each at a cost. Alternatives live in a graph-structured stack: stacks share
their tails, and of alternatives with equal top only the one of least (cost, audit) goes on. That
is exact: what a top can still accept does not depend on the nodes below it, and of two audits of
equal cost for the same rows neither is a prefix of the other, so the order of two
alternatives cannot change later.

The rows of a conversation are never gathered in one task:

* Equal rows (same conversation, turn, role, text) become one row with a number of copies, by an
  aggregate with a map-side step. Rows whose role and text stand at an earlier turn already are found
  by aggregates and joins of keys and SHA-256 hashes, without texts.
* Rows, marks of such duplicates and one row per conversation id are range-partitioned and sorted by
  conversation, turn, role and text (its first characters, then its hash), so that a long
  conversation is cut over tasks at any row.
* A task streams its rows. Conversations that begin and end in it are finished there. Others are cut
  into segments of at most `SEGMENT_ROWS` rows: each is parsed from every stack top that may stand
  before it, which gives a small table of (top before, top after) with the least (cost, audit).
* The tables of a conversation are combined in order, one row per segment. Each segment
  then gets its part of the audit, its repaired rows are written, and their digest is a stream over
  the segments. (One digest over a whole conversation is sequential by its definition; its memory is
  bounded, and nothing else of a conversation is in one place but its audit.)

Defined cases: nulls in role and text are one space; null turns come first; a null conversation id
is a conversation; rows with equal turns are ordered by role, then text; fully repeated rows are duplicates of
the first; an empty role has no initial and can only be re-roled or deleted; a conversation without
rows has zeros, an empty audit and no repaired rows; an empty table gives an empty result; other
columns are not read. Turns must be integers.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from dockwise.llm.common import attach_group_facts, stage

# Costs of the edits, and of a truncated row that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

# LR tables of  S -> . | T | s T ;  T -> u a | T u a  (a reduction is due in states 5 and 7).
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 5, (3, "u"): 6, (4, "u"): 6, (6, "a"): 7}
REDUCE = {5: 2, 7: 3}
GOTO = {0: 3, 1: 4}
ACCEPT = (0, 3, 4)

Stack = tuple  # (state, stack below), shared between alternatives
Tops = dict[int, tuple[int, str, Stack]]  # by top state: cost, audit, stack
START: Stack = (0, None)

SEGMENT_ROWS = 1024
SEGMENT_BYTES = 1 << 20
BLANK = " \t\n\x0b\x0c\r"
ENDS = frozenset(".!?")
LEGAL = frozenset(("su", "ua", "au"))
ROW_EDIT = re.compile("I*[^I]")


# ---------------------------------------------------------------- the parser


def shifted(stack: Stack, terminal: str) -> Stack | None:
    """The stack after a terminal and the reductions that follow, None if it does not fit."""
    to = SHIFT.get((stack[0], terminal))
    if to is None:
        return None
    stack = (to, stack)
    while stack[0] in REDUCE:
        for _ in range(REDUCE[stack[0]]):
            stack = stack[1]
        stack = (GOTO[stack[0]], stack)
    return stack


def offer(tops: Tops, cost: int, audit: str, stack: Stack) -> bool:
    """Merge an alternative into those with its top; whether it is the least of them."""
    held = tops.get(stack[0])
    if held is not None and held[:2] <= (cost, audit):
        return False
    tops[stack[0]] = (cost, audit, stack)
    return True


def with_inserts(tops: Tops) -> Tops:
    out = dict(tops)
    work = list(out.values())
    while work:
        cost, audit, stack = work.pop()
        for terminal in "ua":
            made = shifted(stack, terminal)
            if made is not None and offer(out, cost + INSERT, audit + "I", made):
                work.append(out[made[0]])
    return out


def parsed(tops: Tops, symbols: str) -> Tops:
    """The stack tops after a row per symbol.

    A symbol is a role's initial (`s`, `u`, `a`, else `x`), in capitals if the row is truncated, or
    `d` if it must be deleted. Inserts are tried before rows that may stay; before a row that
    goes, deleting it first costs the same and is the smaller audit.
    """
    for symbol, run in groupby(symbols):
        if symbol == "d":
            n = sum(1 for _ in run)
            tops = {s: (cost + n * DELETE, audit + "D" * n, stack) for s, (cost, audit, stack) in tops.items()}
            continue
        initial, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
        for _ in run:
            after: Tops = {}
            for cost, audit, stack in with_inserts(tops).values():
                offer(after, cost + DELETE, audit + "D", stack)
                for terminal in "sua":
                    made = shifted(stack, terminal)
                    if made is None:
                        continue
                    if terminal == initial:
                        offer(after, cost + extra, audit + "K", made)
                    elif terminal != "s":
                        offer(after, cost + extra + REROLE, audit + "R", made)
            tops = after
    return tops


def accepted(tops: Tops) -> tuple[int, str]:
    """Least (cost, audit) of the alternatives that are complete, or become so by inserts."""
    return min(v[:2] for s, v in with_inserts(tops).items() if s in ACCEPT)


# One stack for every top that may stand before a segment.
ENTRIES: dict[int, Stack] = {stack[0]: stack for stack in (START, *filter(None, (
    shifted(START, "s"), shifted(START, "u"), shifted(shifted(START, "u"), "a"),
    shifted(shifted(shifted(START, "s"), "u"), "a"), shifted(shifted(shifted(START, "u"), "a"), "u"),
)))}


@lru_cache(1 << 16)
def _short(symbols: str) -> tuple[int, str]:
    return accepted(parsed({0: (0, "", START)}, symbols))


def solve(symbols: str) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation."""
    return _short(symbols) if len(symbols) <= 24 else accepted(parsed({0: (0, "", START)}, symbols))


def table(symbols: str, at_start: bool) -> list[dict]:
    """Least (cost, audit) from each top before a segment to each top after it."""
    entries = {0: START} if at_start else ENTRIES
    out = []
    for entry, stack in entries.items():
        for exit_, (cost, audit, _) in parsed({entry: (0, "", stack)}, symbols).items():
            out.append({"entry": entry, "exit": exit_, "cost": cost, "audit": audit})
    return out


class Fold:
    """Combines the tables of a conversation's segments in order."""

    def __init__(self) -> None:
        self.done: list[str] = []  # the part of the audit that all alternatives share
        self.tops: dict[int, tuple[int, str]] = {0: (0, "")}

    def add(self, rows: Iterable[dict]) -> None:
        new: dict[int, tuple[int, str]] = {}
        for r in rows:
            if r["entry"] in self.tops:
                cost, audit = self.tops[r["entry"]]
                made = cost + r["cost"], audit + r["audit"]
                if r["exit"] not in new or made < new[r["exit"]]:
                    new[r["exit"]] = made
        shared = len(os.path.commonprefix([audit for _, audit in new.values()]))
        self.done.append(next(iter(new.values()))[1][:shared])
        self.tops = {s: (cost, audit[shared:]) for s, (cost, audit) in new.items()}

    def result(self) -> tuple[int, str]:
        cost, audit = accepted({s: (cost, audit, ENTRIES[s]) for s, (cost, audit) in self.tops.items()})
        return cost, "".join(self.done) + audit


# ---------------------------------------------------------------- rows of a task


class Run:
    """Rows of one conversation that follow each other in a task, and their counts."""

    def __init__(self, conv, starts: bool) -> None:
        self.conv, self.starts = conv, starts
        self.lines: list[tuple[str, str, int]] = []  # role, text, copies
        self.symbols: list[str] = []
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.bytes = 0
        self.first = self.last = None  # initials
        self.low = self.high = None  # turns
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, copies: int, seen: bool) -> None:
        end = text.rstrip(BLANK)[-1:]
        initial = role[:1]
        symbol = initial if initial and initial in "sua" else "x"
        if not end:
            self.blank += copies
            self.symbols.append("d" * copies)
        else:
            self.duplicate += copies - (not seen)
            if not seen and end not in ENDS:
                self.truncated += 1
                symbol = symbol.upper()
            self.symbols.append("d" * copies if seen else symbol + "d" * (copies - 1))
        self.illegal += (self.last is not None and self.last + initial not in LEGAL) + copies - 1
        self.first, self.last = initial if self.first is None else self.first, initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.rows += copies
        self.bytes += len(text)
        self.lines.append((role, text, copies))

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def repaired(lines: Iterable[tuple[str, str, int]], audit: str, before: int, odd: bool) -> list[tuple[str, str, str]]:
    """`(edit, role, text)` of the rows that an audit leaves; `before` of the conversation's rows
    precede them, and an odd number of rows in all means a system row in front."""
    copies = ((role, text) for role, text, n in lines for _ in range(n))
    out = []
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(copies)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if (before + len(out) - odd) % 2 else "user"
        out.append((edit, role, text))
    return out


def joined(rows: list[tuple[str, str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for _, role, text in rows).encode()


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_LINES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("copies", pa.int64())]))
_TABLE = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_REPAIRED = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
# Columns of the table of finished conversations and segments: name, Spark type, Arrow type.
PARTS = [
    ("conv", None, None), ("part", "int", pa.int32()), ("seq", "int", pa.int32()), ("done", "boolean", pa.bool_()),
    *[(c, "long", pa.int64()) for c in COUNTS], ("audit", "string", pa.string()), ("sha256", "string", pa.string()),
    ("rows", "long", pa.int64()), ("first", "string", pa.string()), ("last", "string", pa.string()),
    ("low", "long", pa.int64()), ("high", "long", pa.int64()), ("turns", "long", pa.int64()),
    ("paths", "array<struct<entry:int,exit:int,cost:long,audit:string>>", _TABLE),
    ("lines", "array<struct<role:string,text:string,copies:long>>", _LINES),
    ("repaired", "array<struct<edit:string,role:string,text:string>>", _REPAIRED),
]


class _Out:
    """Collects rows of one schema and hands them out as batches."""

    def __init__(self, columns: list[tuple[str, str, pa.DataType]], conv_type: pa.DataType) -> None:
        self.types = [(name, kind or conv_type) for name, _, kind in columns]
        self.rows: list[dict] = []
        self.size = 0

    def add(self, size: int, **row) -> None:
        self.rows.append(row)
        self.size += size + 200

    def batches(self, least: int = 8 << 20) -> Iterator[pa.RecordBatch]:
        if self.rows and self.size >= least:
            yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in self.rows], t) for n, t in self.types], [n for n, _ in self.types])
            self.rows, self.size = [], 0


def _ddl(columns: list[tuple[str, str, pa.DataType]], conv_type) -> StructType:
    types = StructType.fromDDL(", ".join(f"`{n}` {t or 'int'}" for n, t, _ in columns))
    return StructType([StructField(f.name, conv_type if n == "conv" and t is None else f.dataType) for f, (n, t, _) in zip(types, columns, strict=True)])


def _arrow_type(kind) -> pa.DataType:
    return pa.string() if isinstance(kind, StringType) else pa.int64()


# ---------------------------------------------------------------- Spark plan


def _ordered_rows(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows, marks of duplicates and one row per conversation, range-partitioned and sorted.

    `kind` 0: begin of a conversation; 1: the row that follows is a duplicate; 2: a row.
    """
    same = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    keyed = rows.withColumns({"head": F.substring("text", 1, 32), "hash": F.unhex(F.sha2(same, 256))})
    order = ["conv", "turn", "role", "head", "hash"]
    texts = keyed.groupBy(*order, "text").agg(F.count(F.lit(1)).alias("copies"))
    group = {"_c": F.coalesce(F.col("conv").cast("string"), F.lit("")), "_none": F.col("conv").isNull()}
    keys = stage(keyed.select(*order).distinct().withColumns(group), "repair-keys")
    facts = keys.groupBy(*group, "hash").agg(
        F.count(F.lit(1)).alias("n"), F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("any_null")
    )
    repeated = stage(facts.where("n > 1"), "repair-repeated")
    known = attach_group_facts(keys, repeated, [*group, "hash"], "n", "turn").where("n IS NOT NULL")
    first = F.when(F.col("any_null"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("least"))
    marks = known.where(~first).select(*order, F.lit(1).alias("kind"))
    begins = ids.select("conv").distinct().withColumn("kind", F.lit(0))
    all_rows = texts.withColumn("kind", F.lit(2)).unionByName(marks, True).unionByName(begins, True)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return all_rows.repartitionByRange(n, *order).sortWithinPartitions(*order, "kind").select("conv", "turn", "role", "text", "copies", "kind")


def _parts(ordered: DataFrame, with_rows: bool) -> DataFrame:
    """Finished conversations, and segments of those that a task holds a part of only."""
    conv_type = ordered.schema["conv"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(PARTS, _arrow_type(conv_type))
        part, seq, held, cut, seen = TaskContext.get().partitionId(), 0, None, False, False

        def close(r: Run, whole: bool) -> None:
            counts = dict(blank=r.blank, duplicate=r.duplicate, truncated=r.truncated, illegal=r.illegal)
            symbols = "".join(r.symbols)
            if whole:
                cost, audit = solve(symbols)
                left = repaired(r.lines, audit, 0, (len(audit) - audit.count("D")) % 2 == 1)
                body = joined(left)
                shown = [dict(zip(("edit", "role", "text"), x, strict=True)) for x in left] if with_rows else None
                out.add(
                    len(body) if with_rows else 0, conv=r.conv, part=part, seq=seq, done=True, gaps=r.gaps(), **counts,
                    cost=cost, audit=audit, sha256=hashlib.sha256(body).hexdigest(), repaired=shown,
                )
            else:
                lines = [dict(zip(("role", "text", "copies"), x, strict=True)) for x in r.lines]
                out.add(
                    r.bytes, conv=r.conv, part=part, seq=seq, done=False, **counts, rows=r.rows, first=r.first, last=r.last,
                    low=r.low, high=r.high, turns=r.turns, paths=table(symbols, r.starts), lines=lines,
                )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "copies", "kind")]
            for conv, turn, role, text, copies, kind in zip(*columns, strict=True):
                if held is None or kind == 0 or held.conv != conv:
                    if held is not None:
                        close(held, whole=held.starts and not cut)
                        seq += 1
                        yield from out.batches()
                    held, cut, seen = Run(conv, starts=kind == 0), False, False
                if kind == 1:
                    seen = True
                elif kind == 2:
                    if len(held.lines) >= SEGMENT_ROWS or held.bytes >= SEGMENT_BYTES:
                        close(held, whole=False)
                        seq += 1
                        yield from out.batches()
                        held, cut = Run(conv, starts=False), True
                    held.add(turn, role, text, copies, seen)
                    seen = False
        if held is not None:
            close(held, whole=False)
        yield from out.batches(0)

    return ordered.mapInArrow(run, _ddl(PARTS, conv_type))


_DECIDED = [
    ("conv", None, None), ("part", "int", pa.int32()), ("seq", "int", pa.int32()), ("piece", "string", pa.string()),
    ("before", "long", pa.int64()), ("odd", "boolean", pa.bool_()), ("final", "boolean", pa.bool_()),
    *[(c, "long", pa.int64()) for c in COUNTS], ("audit", "string", pa.string()),
]


def _by_conversation(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Sorted rows, conversation by conversation."""
    rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in columns), strict=True))
    return groupby(rows, key=lambda r: (r[0] is not None, r[0]))


def _decide(segments: DataFrame) -> DataFrame:
    """The audit of each segmented conversation, and the part of it that each segment has."""
    conv_type = segments.schema["conv"].dataType
    columns = ["conv", "part", "seq", "blank", "duplicate", "truncated", "illegal", "rows", "first", "last", "low", "high", "turns", "paths"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(_DECIDED, _arrow_type(conv_type))
        for _, rows in _by_conversation(batches, columns):
            fold, places, sums = Fold(), [], [0, 0, 0, 0]
            last = low = high = None
            turns = 0
            for conv, part, seq, *counts, n, first, end, lo, hi, distinct, paths in rows:
                fold.add(paths)
                places.append((part, seq, n))
                sums = [a + b for a, b in zip(sums, counts, strict=True)]
                if first is not None:
                    sums[3] += last is not None and last + first not in LEGAL
                    last = end
                if lo is not None:
                    turns += distinct - (lo == high)
                    low, high = lo if low is None else low, hi
            cost, audit = fold.result()
            kept = len(audit) - audit.count("D")
            at = before = 0
            for k, (part, seq, n) in enumerate(places):
                final = k == len(places) - 1
                end_at = len(audit) if final else _after_rows(audit, at, n)
                piece = audit[at:end_at]
                row = dict(conv=conv, part=part, seq=seq, piece=piece, before=before, odd=kept % 2 == 1, final=final)
                if final:
                    gaps = 0 if low is None else high - low + 1 - turns
                    row |= dict(gaps=gaps, blank=sums[0], duplicate=sums[1], truncated=sums[2], illegal=sums[3], cost=cost, audit=audit)
                out.add(len(piece) + final * len(audit), **row)
                at, before = end_at, before + len(piece) - piece.count("D")
                yield from out.batches()
        yield from out.batches(0)

    dealt = segments.select(*columns).repartition("conv").sortWithinPartitions("conv", "part", "seq")
    return dealt.mapInArrow(run, _ddl(_DECIDED, conv_type))


def _after_rows(audit: str, at: int, rows: int) -> int:
    """Where the audit of `rows` rows ends that begins at `at`, inserts before a row included."""
    if rows:
        for found in ROW_EDIT.finditer(audit, at):
            rows -= 1
            if rows == 0:
                return found.end()
    return at


def _render(segments: DataFrame, decided: DataFrame) -> DataFrame:
    """`(conv, part, seq, body, repaired)` of each segment with what `decided` holds."""
    conv_type = segments.schema["conv"].dataType
    columns = [*_DECIDED, ("body", "binary", pa.binary()), ("repaired", PARTS[-1][1], _REPAIRED)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(columns, _arrow_type(conv_type))
        names = [n for n, _, _ in _DECIDED]
        for batch in batches:
            for row in range(batch.num_rows):
                r = {n: batch.column(n)[row].as_py() for n in (*names, "lines")}
                lines = ((x["role"], x["text"], x["copies"]) for x in r.pop("lines"))
                left = repaired(lines, r["piece"], r["before"], r["odd"])
                shown = [dict(zip(("edit", "role", "text"), x, strict=True)) for x in left]
                out.add(sum(len(x[2]) for x in left) * 2, **r, body=joined(left) if left else None, repaired=shown)
                yield from out.batches()
        yield from out.batches(0)

    both = segments.select("part", "seq", "lines").join(decided, ["part", "seq"])
    return both.mapInArrow(run, _ddl(columns, conv_type))


def _hashed(rendered: DataFrame) -> DataFrame:
    """One row per segmented conversation: its counts, audit and the digest of its segments."""
    conv_type = rendered.schema["conv"].dataType
    columns = [("conv", None, None), *[(c, "long", pa.int64()) for c in COUNTS], ("audit", "string", pa.string()), ("sha256", "string", pa.string())]
    names = ["conv", "body", "final", *COUNTS, "audit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(columns, _arrow_type(conv_type))
        for _, rows in _by_conversation(batches, names):
            digest, begun = hashlib.sha256(), False
            for conv, body, final, *counts, audit in rows:
                if body is not None:
                    digest.update(b"\n" + body if begun else body)
                    begun = True
                if final:
                    out.add(len(audit), conv=conv, **dict(zip(COUNTS, counts, strict=True)), audit=audit, sha256=digest.hexdigest())
            yield from out.batches()
        yield from out.batches(0)

    dealt = rendered.repartition("conv").sortWithinPartitions("conv", "part", "seq").select(*names)
    return dealt.mapInArrow(run, _ddl(columns, conv_type))


def repair(rows: DataFrame, conversations: DataFrame | None = None, conv_col: str = "conv_id", with_rows: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Repair the conversations of `rows` (`conv_col, turn, role, text`).

    Returns one row per conversation (`conv_col, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256`), and with `with_rows` the repaired rows (`conv_col, position, edit,
    role, text`). `conversations` may name conversations that have no rows.
    """
    null = F.lit(" ")
    plain = rows.select(
        F.col(conv_col).alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role"), null).alias("role"), F.coalesce(F.col("text"), null).alias("text"),
    )
    if not isinstance(plain.schema["conv"].dataType, (LongType, StringType)):
        plain = plain.withColumn("conv", F.col("conv").cast("bigint"))
    ids = (rows if conversations is None else conversations).select(F.col(conv_col).cast(plain.schema["conv"].dataType).alias("conv"))
    parts = stage(_parts(_ordered_rows(plain, ids), with_rows), "repair-parts")
    segments = parts.where("NOT done")
    rendered = stage(_render(segments, stage(_decide(segments), "repair-decided")), "repair-rendered")
    columns = ["conv", *COUNTS, "audit", "sha256"]
    report = parts.where("done").select(*columns).unionByName(_hashed(rendered).select(*columns))
    report = report.withColumnsRenamed({"conv": conv_col, "sha256": "repaired_sha256"})
    if not with_rows:
        return report, None
    whole = parts.where("done").select("conv", F.lit(0).cast("bigint").alias("before"), "repaired")
    lines = whole.unionByName(rendered.select("conv", "before", "repaired"))
    lines = lines.select(F.col("conv").alias(conv_col), "before", F.posexplode("repaired").alias("i", "r"))
    return report, lines.select(conv_col, (F.col("before") + F.col("i")).alias("position"), "r.*")


def damaged(conversations: DataFrame) -> DataFrame:
    """The registered query's damage, drawn by a checksum of `conv_id:turn` (nulls: one space)."""
    null = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), null), F.lit(":"), F.coalesce(F.col("turn").cast("string"), null))
    text, role = F.coalesce(F.col("text"), null), F.coalesce(F.col("role"), null)
    drawn = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name) % 20).alias("draw"))
    copies = F.explode(F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    return drawn.where("draw <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def digest(conversations: DataFrame) -> DataFrame:
    """The registered query's columns, for every conversation before damage."""
    return repair(damaged(conversations), conversations, with_rows=False)[0]
