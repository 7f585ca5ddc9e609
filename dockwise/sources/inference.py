"""Schema inference over JSON lines as one distributed aggregate, with drift per field.

Every value of a line counts at its path: a field of an object is `parent.name`, an element of a
list `parent[]`, the line itself `$`. Values are not expanded one by one: objects without lists
inside are counted by shape (their names and types) with a map-side step, and only one of each
shape is taken apart, its fields standing for all of them; only what holds a list is opened value
by value. What is shuffled is a row per path, shape and task. The per-path report follows
from that small table: how often a field is there, null or missing from its object, its types,
the type that holds all of them, and how it differs from a declared schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

ROOT = "$"
INVALID = "INVALID"  # type of a line that is no JSON


def _shape(value: Column) -> Column:
    """The value's type with all names and types below it."""
    return F.coalesce(F.schema_of_variant(value), F.lit(INVALID))


def _kind(shape: Column) -> Column:
    """`OBJECT`, `ARRAY`, `BIGINT`, `DECIMAL`, `DOUBLE`, `STRING`, `BOOLEAN` or `VOID`."""
    return F.substring_index(F.substring_index(shape, "<", 1), "(", 1)


def _opened(rows: DataFrame, levels: int, test: Column) -> DataFrame:
    """Replace values that meet `test` by themselves (without content) and their fields or
    elements, level by level. Rows are `path, parent, level, v, shape, n`."""
    test = test & (F.col("level") < levels)

    def child(path: Column, parent: Column, v: Column) -> Column:
        below = (F.col("level") + 1).alias("level")
        return F.struct(path.alias("path"), parent.alias("parent"), below, v.alias("v"), _shape(v).alias("shape"), F.col("n").alias("n"))

    none = F.lit(None).cast("string")
    for _ in range(levels):
        # The casts are evaluated only where they fit.
        entries = F.map_entries(F.when(test & F.startswith("shape", F.lit("OBJECT<")), F.col("v").cast("map<string,variant>")))
        fields = F.transform(entries, lambda e: child(F.concat("path", F.lit("."), e["key"]), F.col("path"), e["value"]))
        items = F.when(test & F.startswith("shape", F.lit("ARRAY<")), F.col("v").cast("array<variant>"))
        elements = F.transform(items, lambda e: child(F.concat("path", F.lit("[]")), none, e))
        closed = F.when(test, _kind(F.col("shape"))).otherwise(F.col("shape"))
        own = F.struct("path", "parent", "level", F.when(~test, F.col("v")).alias("v"), closed.alias("shape"), "n")
        rows = rows.select(F.inline(F.concat(F.array(own), F.coalesce(fields, elements, F.array()))))
    return rows


def value_counts(lines: DataFrame, value: str = "value", depth: int = 4) -> DataFrame:
    """`path, parent, kind, n`: values of each kind at each path down to `depth` levels. Blank lines
    do not count; only fields of objects have a parent."""
    text = lines.where(F.trim(F.col(value)) != "").select(F.try_parse_json(value).alias("v"))
    one = F.lit(1).cast("bigint")
    root = [F.lit(ROOT).alias("path"), F.lit(None).cast("string").alias("parent"), F.lit(0).alias("level")]
    rows = text.select(*root, "v", _shape(F.col("v")).alias("shape"), one.alias("n"))
    rows = _opened(rows, depth, F.contains("shape", F.lit("ARRAY<")))
    example = F.any_value(F.when(F.startswith("shape", F.lit("OBJECT<")), F.col("v")), True)
    shapes = rows.groupBy("path", "parent", "level", "shape").agg(example.alias("v"), F.sum("n").alias("n"))
    values = _opened(shapes.select("path", "parent", "level", "v", "shape", "n"), depth, F.startswith("shape", F.lit("OBJECT<")))
    return values.groupBy("path", "parent", _kind(F.col("shape")).alias("kind")).agg(F.sum("n").alias("n"))


def _widest(kinds: Column) -> Column:
    """The type that holds all kinds of a path."""
    known = F.array_remove(F.array_remove(kinds, "VOID"), INVALID)
    numbers = F.forall(known, lambda k: k.isin("BIGINT", "DECIMAL", "DOUBLE"))
    return (
        F.when(F.size(known) == 0, F.lit("VOID"))
        .when(F.size(known) == 1, known[0])
        .when(numbers, F.when(F.array_contains(known, "DOUBLE"), F.lit("DOUBLE")).otherwise(F.lit("DECIMAL")))
        .otherwise(F.lit("STRING"))
    )


def declared_paths(schema: StructType) -> list[tuple[str, str | None, str]]:
    """Paths, parents and kinds that a schema declares."""
    names = {"struct": "OBJECT", "array": "ARRAY"}
    out: list[tuple[str, str | None, str]] = []

    def walk(path: str, parent: str | None, kind: DataType) -> None:
        out.append((path, parent, names.get(kind.typeName(), kind.simpleString().upper())))
        if isinstance(kind, StructType):
            for f in kind.fields:
                walk(f"{path}.{f.name}", path, f.dataType)
        elif isinstance(kind, ArrayType):
            walk(f"{path}[]", None, kind.elementType)

    walk(ROOT, None, schema)
    return out


def field_report(lines: DataFrame, declared: StructType, value: str = "value", depth: int | None = None) -> DataFrame:
    """One row per path: `path, n, nulls, missing, kinds, inferred, declared, drift`.

    Paths go down to `depth` levels, by default one more than the schema declares.

    `n` counts the values at the path, `missing` the objects without the field. `drift` is empty,
    `undeclared`, `absent` (declared, in no line) or `type` (the inferred type does not fit).
    """
    spark = lines.sparkSession
    named_paths = declared_paths(declared)
    if depth is None:
        depth = 1 + max(path.count(".") + path.count("[]") for path, _, _ in named_paths)
    found = value_counts(lines, value, depth).groupBy("path", "parent").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("kind") == "VOID", F.col("n")).otherwise(0)).alias("nulls"),
        F.sum(F.when(F.col("kind") == "OBJECT", F.col("n")).otherwise(0)).alias("objects"),
        F.sort_array(F.collect_set("kind")).alias("kinds"),
    )
    parents = found.groupBy(F.col("path").alias("parent")).agg(F.sum("objects").alias("parent_objects"))
    named = spark.createDataFrame(named_paths, "path string, named_parent string, declared string")
    both = found.join(named, "path", "full").withColumn("parent", F.coalesce("parent", "named_parent")).join(parents, "parent", "left")
    inferred = _widest(F.col("kinds"))
    fits = inferred.isin("VOID") | (inferred == F.col("declared")) | (inferred.isin("BIGINT", "DECIMAL") & (F.col("declared") == "DOUBLE"))
    drift = (
        F.when(F.col("n").isNull(), F.lit("absent"))
        .when(F.col("declared").isNull(), F.lit("undeclared"))
        .when(~fits, F.lit("type"))
        .otherwise(F.lit(""))
    )
    n = F.coalesce("n", F.lit(0))
    return both.select(
        "path",
        n.alias("n"),
        F.coalesce("nulls", F.lit(0)).alias("nulls"),
        F.when(F.col("parent").isNull(), F.lit(0)).otherwise(F.coalesce("parent_objects", F.lit(0)) - n).cast("bigint").alias("missing"),
        F.array_join(F.coalesce("kinds", F.array().cast("array<string>")), ",").alias("kinds"),
        F.when(F.col("n").isNotNull(), inferred).alias("inferred"),
        "declared",
        drift.alias("drift"),
    )
