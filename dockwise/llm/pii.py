"""Personal data by patterns, and terms that give it away by corpus statistics.

Only DataFrame functions run here, on the driver's plan and on the executors.

Base spans are leftmost, non-overlapping matches per kind. A pattern's matches and the gaps
between them (`regexp_extract_all`, `split`) give positions: a running sum over lengths. The
patterns are written with possessive quantifiers, and starts inside a run are excluded, so
that long runs cost linear time and no recursion; they match exactly what the plain forms in
`PATTERNS` match.

Information-theoretic sanitisation. Each distinct base value is a protected entity. For a
term `t` seen within `CONTEXT` words of an entity `e`, the disclosure is the pointwise
mutual information relative to the entity's information content,

    PMI(e, t) / IC(e) = 1 + log2(n(e, t) / (n(t) + c)) / log2(N / n(e)),

counted over documents: n(e, t) holding the term near the entity, n(t) holding the term
anywhere, n(e) holding the entity, N all. It is near 1 for a term found nowhere else. `c` shrinks
estimates on little evidence: it stands for `prior` further texts that hold the term without
the entity (each with as many copies as the texts that do have on average). So rare entities,
which a rare word beside them reveals most, have estimates too, which fall short of those
that several texts bear out; copies of one text are one text. The `CONTEXT` words on each side are
counted in the whole text, whatever other matches lie between; a word that the span's edge cuts
counts with its part outside. The text is read in growing stretches, mostly the first of
`REACHES`, until a stretch holds enough words or ends with the text. Terms of at least `generalise` are
generalised, of at least `remove` removed, at all their places in documents that hold that
entity. Counts cover all documents and
are made with map-side aggregates.

Defined cases: null texts are empty; fully repeated rows get equal results and are separate
documents with one text; ids may be null; values that fail the checks
(address parts, digits, Luhn) are dropped without another try; an empty table gives an empty
result. Positions are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockwise.llm.common import KEY, attach_group_facts, stage, with_row_key

# The kinds in their order, as given.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# The same languages for a backtracking matcher: linear, without recursion.
MATCHERS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# A text without this character has no match.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
KINDS = tuple(PATTERNS)
TERM = r"[\p{L}\p{N}]+"
CONTEXT = 8
REACHES = (160, 2560, 40960, 655360)  # code points looked at for the context words, then all
PIECE = 4096  # code points


def _matches(kind: str) -> Column:
    """Array of a kind's matches with the lengths of the gaps before them."""
    text = F.col("text")
    found = F.regexp_extract_all(text, F.lit(MATCHERS[kind]), F.lit(0))
    gaps = F.split(text, MATCHERS[kind], -1)
    n = F.size(found)
    rows = F.arrays_zip(found.alias("value"), F.slice(gaps, F.lit(1), n).alias("before"))
    parts = F.transform(
        rows,
        lambda r: F.struct(
            F.lit(kind).alias("kind"),
            r["value"].alias("value"),
            F.length(r["before"]).cast("long").alias("gap"),
        ),
    )
    may = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else text.rlike("[0-9]{2}|[0-9][ -][0-9]")
    return F.when(may, parts).otherwise(F.array().cast(_MATCH))


_MATCH = "array<struct<kind:string,value:string,gap:bigint>>"


def _valid(kind: Column, value: Column) -> Column:
    """Does a match hold up: address parts, number of digits, Luhn sum."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    parts = F.forall(F.split(value, r"\."), lambda p: p.try_cast("double") <= 255)
    # Every second digit from the right is doubled; the digits of the result are summed.
    reverse = F.split(F.reverse(digits), "")
    doubled = F.transform(
        F.slice(reverse, F.lit(1), F.least(n, F.lit(19))),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5)),
    )
    luhn = F.aggregate(doubled, F.lit(0).cast("long"), lambda s, d: s + d) % 10 == 0
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", parts)
        .when(kind == "card", F.when(n.between(12, 19), luhn).otherwise(F.lit(False)))
        .otherwise(n.between(9, 15))
    )


def base_spans(keyed: DataFrame) -> DataFrame:
    """One row per base span: row key, kind, value, place, entity."""
    exploded = keyed.select(*KEY, "_t1", "_t2", F.posexplode(F.concat(*[_matches(k) for k in KINDS])).alias("i", "m"))
    # Repeated rows give the same matches; one of each is kept, with their number.
    same = [*KEY, "_t1", "_t2", "i", "kind", "value", "gap"]
    rows = exploded.select(*KEY, "_t1", "_t2", "i", "m.*").groupBy(*same).agg(F.count(F.lit(1)).alias("copies"))
    w = Window.partitionBy(*KEY, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(w)
    placed = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
    value = F.when(F.col("kind") == "email", F.lower("value")).otherwise(F.regexp_replace("value", "[^0-9.]" , ""))
    valid = placed.where(_valid(F.col("kind"), F.col("value"))).withColumn("entity", F.concat_ws(":", "kind", value))
    return stage(valid.drop("i", "gap"), "pii-base")


def holding(keyed: DataFrame) -> DataFrame:
    """Row key and text, once each, of the documents that hold a base span."""
    some = F.exists(F.concat(*[_matches(k) for k in KINDS]), lambda m: _valid(m["kind"], m["value"]))
    return stage(keyed.where(some).groupBy(*KEY, "_t1", "_t2").agg(F.first("text").alias("text")), "pii-texts")


def _words_at(chunk: Column, offset: Column) -> Column:
    """Words of a short text with their place in the document."""
    found = F.regexp_extract_all(chunk, F.lit(TERM), F.lit(0))
    gaps = F.split(chunk, TERM, -1)
    rows = F.arrays_zip(found.alias("w"), F.slice(gaps, F.lit(1), F.size(found)).alias("g"))
    empty = F.array().cast("array<struct<w:string,start:bigint,end:bigint>>")
    done = F.aggregate(
        rows,
        F.struct(offset.cast("long").alias("at"), empty.alias("out")),
        lambda acc, r: F.struct(
            (acc["at"] + F.length(r["g"]) + F.length(r["w"])).alias("at"),
            F.concat(
                acc["out"],
                F.array(F.struct(r["w"].alias("w"), (acc["at"] + F.length(r["g"])).alias("start"), (acc["at"] + F.length(r["g"]) + F.length(r["w"])).alias("end"))),
            ).alias("out"),
        ),
    )
    return done["out"]


def _stretch(start: Column, end: Column) -> Column:
    """The code points from `start` to `end`, out of the text's `pieces`."""
    first = F.floor(start / PIECE)
    some = F.slice("pieces", (first + 1).cast("int"), (F.floor(F.greatest(end - 1, start) / PIECE) - first + 1).cast("int"))
    return F.substring(F.array_join(some, ""), (start - first * PIECE + 1).cast("int"), (end - start).cast("int"))


def _first_enough(size: Column, stretch) -> Column:
    """The shortest reach whose stretch has a word more than needed, as its last may be cut."""
    reach = F.when(size <= REACHES[0], size)
    for r in REACHES:
        words = F.size(F.regexp_extract_all(stretch(F.lit(r)), F.lit(TERM), F.lit(0)))
        reach = reach.when((size > r) & (words > CONTEXT), F.lit(r).cast("long"))
    return reach.otherwise(size)


def contexts(base: DataFrame, held: DataFrame) -> DataFrame:
    """One row per entity occurrence and word beside it."""
    places = base.groupBy(*KEY).agg(F.collect_list(F.struct("entity", "start", "end")).alias("spans"), F.max("copies").alias("copies"))
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    whole = held.join(places, list(KEY)).withColumns({"pieces": cut, "size": F.length("text").cast("long")})

    def reached(s: Column) -> Column:
        left = _first_enough(s["start"], lambda r: _stretch(s["start"] - r, s["start"]))
        right = _first_enough(F.col("size") - s["end"], lambda r: _stretch(s["end"], s["end"] + r))
        return F.struct(s["entity"].alias("entity"), s["start"].alias("start"), s["end"].alias("end"), (s["start"] - left).alias("lo"), (s["end"] + right).alias("hi"))

    texts = lambda s: F.struct(
        s["entity"].alias("entity"), s["start"].alias("start"), s["end"].alias("end"), s["lo"].alias("lo"), s["hi"].alias("hi"),
        _stretch(s["lo"], s["start"]).alias("before"), _stretch(s["end"], s["hi"]).alias("after"),
    )
    base = whole.select(*KEY, "_t1", "_t2", "copies", "size", F.explode(F.transform(F.transform("spans", reached), texts)).alias("s"))
    base = base.select(*KEY, "_t1", "_t2", "copies", "size", "s.*")
    # A word cut by the stretch's far edge is left out.
    before = F.filter(_words_at(F.col("before"), F.col("lo")), lambda x: (x["start"] > F.col("lo")) | (F.col("lo") == 0))
    before = F.slice(before, F.greatest(F.lit(1), F.size(before) - CONTEXT + 1), F.lit(CONTEXT))
    after = F.filter(_words_at(F.col("after"), F.col("end")), lambda x: (x["end"] < F.col("hi")) | (F.col("hi") == F.col("size")))
    near = F.concat(before, F.slice(after, F.lit(1), F.lit(CONTEXT)))
    rows = base.select(*KEY, "_t1", "_t2", "copies", "entity", F.explode(near).alias("x"))
    return rows.select(*KEY, "_t1", "_t2", "copies", "entity", F.lower("x.w").alias("term"), "x.start", "x.end")


def disclosures(keyed: DataFrame, seen: DataFrame, prior: float, generalise: float) -> DataFrame:
    """`(entity, term, uses, degree)` of pairs whose disclosure reaches `generalise`."""
    text = ["_t1", "_t2"]
    per_document = seen.groupBy("entity", "term", *text, *KEY).agg(F.max("copies").alias("n"), F.count(F.lit(1)).alias("uses"))
    per_text = per_document.groupBy("entity", "term", *text).agg(F.sum("n").alias("n"), F.sum("uses").alias("uses"))
    pairs = per_text.groupBy("entity", "term").agg(F.sum("n").alias("n_et"), F.sum("uses").alias("uses"), F.count(F.lit(1)).alias("texts"))
    pairs = stage(pairs, "pii-pairs")
    entities = seen.select("entity", *KEY, "copies").distinct().groupBy("entity").agg(F.sum("copies").alias("n_e"))
    n_all = keyed.count()
    # Document frequency of the terms that occur in pairs, over the whole corpus.
    terms = pairs.select("term").distinct()
    words = keyed.select(F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))).alias("term"))
    n_t = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_t")).join(terms, "term", "left_semi")
    judged = pairs.join(entities, "entity").join(n_t, "term").withColumn("n_all", F.lit(n_all))
    information = F.log2(F.col("n_all") / F.col("n_e"))
    held = F.greatest("n_t", "n_et") + F.lit(prior) * F.col("n_et") / F.col("texts")
    degree = F.when(information > 0, 1 + F.log2(F.col("n_et") / held) / information)
    return judged.select("entity", "term", "uses", degree.alias("degree")).where(F.col("degree") >= generalise)


def all_places(base: DataFrame, held: DataFrame, told: DataFrame) -> DataFrame:
    """Places of disclosing terms in the documents that hold their entity: key, start, end, degree."""
    terms = told.select("term").distinct()
    words = held.select(*KEY, F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))).alias("term")).join(terms, "term", "left_semi")
    met = words.join(base.select(*KEY, "entity").distinct(), list(KEY))
    degrees = attach_group_facts(met, told, ["entity", "term"], "uses", "_k1").where("degree IS NOT NULL").groupBy(*KEY, "term").agg(F.max("degree").alias("degree"))
    sought = degrees.groupBy(*KEY).agg(F.map_from_entries(F.collect_list(F.struct("term", "degree"))).alias("sought"))
    found = F.regexp_extract_all("text", F.lit(TERM), F.lit(0))
    rows = F.arrays_zip(found.alias("w"), F.slice(F.split("text", TERM, -1), F.lit(1), F.size(found)).alias("g"))

    def step(acc: Column, r: Column) -> Column:
        start = acc["at"] + F.length(r["g"])
        end = start + F.length(r["w"])
        degree = F.element_at("sought", F.lower(r["w"]))
        hit = F.array(F.struct(start.alias("start"), end.alias("end"), degree.alias("degree")))
        return F.struct(end.alias("at"), F.when(degree.isNotNull(), F.concat(acc["out"], hit)).otherwise(acc["out"]).alias("out"))

    none = F.array().cast("array<struct<start:bigint,end:bigint,degree:double>>")
    done = F.aggregate(rows, F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")), step)
    return held.join(sought, list(KEY)).select(*KEY, F.inline(done["out"]))


def find_spans(docs: DataFrame, prior: float = 2.0, generalise: float = 0.75, remove: float = 0.9, id_col: str = "doc_id") -> DataFrame:
    """`(_id, text, base, spans)`: sorted arrays of `(start, rank, end, kind, action)`."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = with_row_key(rows, "_id", "text").withColumns({"_t1": F.xxhash64("text"), "_t2": F.xxhash64(F.lit("second"), "text")})
    base = base_spans(keyed)
    held = holding(keyed)
    seen = stage(contexts(base, held), "pii-contexts")
    told = stage(disclosures(keyed, seen, prior, generalise), "pii-disclosures")
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    found = base.select(*KEY, F.struct("start", rank[F.col("kind")].alias("rank"), "end", "kind", F.lit("mask").alias("action")).alias("span"))
    action = F.when(F.col("degree") >= remove, "remove").otherwise("generalise")
    # Words that a base span's edge cuts are found beside it only.
    beside = attach_group_facts(seen, told, ["entity", "term"], "uses", "_k1").where("degree IS NOT NULL").select(*KEY, "start", "end", "degree")
    terms = beside.union(all_places(base, held, told)).groupBy(*KEY, "start", "end").agg(F.max("degree").alias("degree"))
    added = terms.select(*KEY, F.struct("start", F.lit(len(KINDS)).alias("rank"), "end", F.lit("term").alias("kind"), action.alias("action")).alias("span"))
    spans = found.union(added).distinct().groupBy(*KEY).agg(F.array_sort(F.collect_list("span")).alias("all"))
    joined = keyed.select("_id", *KEY, "text").join(spans, list(KEY), "left")
    return _separate(joined)


def _separate(joined: DataFrame) -> DataFrame:
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,action:string>>")
    every = F.coalesce("all", none)
    base = F.filter(every, lambda s: s["kind"] != "term")
    split = joined.select("_id", "text", every.alias("every"), base.alias("base"))
    # A term inside a base span is part of it.
    spans = F.filter(
        "every", lambda s: (s["kind"] != "term") | ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    )
    return split.select("_id", "text", "base", spans.alias("spans"))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitised(docs: DataFrame, **settings) -> DataFrame:
    """`(_id, text)` with base values masked, terms generalised to their form or removed."""
    found = find_spans(docs, **settings)
    text = F.col("text")
    form = lambda s: F.substring(text, (s["start"] + 1).cast("int"), F.lit(1))
    put = lambda s: (
        F.when(s["kind"] != "term", F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        .when(s["action"] == "remove", F.lit(""))
        .when(form(s).rlike("[0-9]"), F.lit("[NUMBER]"))
        .when(form(s).rlike(r"\p{Lu}"), F.lit("[NAME]"))
        .otherwise(F.lit("[TERM]"))
    )
    done = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= acc["at"],
                F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), put(s)),
            ).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))),
    )
    return found.select("_id", F.when(F.size("spans") > 0, done).otherwise(text).alias("text"))


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns."""
    found = find_spans(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        F.col("_id").alias("doc_id"), *[count(k) for k in KINDS],
        F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"),
    )
