"""Ingest that sets broken lines aside: one pass over the text, two outputs, observed counts.

`split_lines` parses every line once and writes one table in two folders: `broken=false` holds the
parsed fields, `broken=true` the raw text and a reason. Reading either output prunes the other
folder. Counts are observed while writing, so no second pass counts them.

* malformed: no JSON value, for example a line cut short;
* not an object: valid JSON, but a list, number, text or null;
* field type: an object with a field that does not fit its declared type.

Blank lines are counted and give no row, as with the JSON reader.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

LINE, REASON, BROKEN = "broken_line", "reason", "broken"


@dataclass(frozen=True)
class SplitLines:
    """`good` has the schema's fields, `broken` has `broken_line, reason`; `counts` has
    `lines, blank, good, broken`, where lines = blank + good + broken."""

    good: DataFrame
    broken: DataFrame
    counts: dict[str, int]


def broken_reason(line: Column) -> Column:
    """Why a line that did not parse is broken."""
    value = F.try_parse_json(line)
    return (
        F.when(value.isNull(), F.lit("malformed"))
        .when(F.schema_of_variant(value).startswith("OBJECT"), F.lit("field type"))
        .otherwise(F.lit("not an object"))
    )


def parse_or_keep(lines: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Every non-null line: the schema's fields, `broken_line` (null if it parsed) and `blank`."""
    with_line = StructType([*schema.fields, StructField(LINE, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE}
    parsed = F.from_json(value, with_line, options)
    blank = F.trim(F.regexp_replace(value, r"[\t\n\r]", " ")) == ""
    return lines.where(F.col(value).isNotNull()).select(parsed.alias("r"), blank.alias("blank")).select("r.*", "blank")


def split_lines(lines: DataFrame, schema: StructType, path: str, value: str = "value") -> SplitLines:
    """Parse `lines`, write both outputs below `path`, and return them with their counts."""
    spark = lines.sparkSession
    rows = parse_or_keep(lines, schema, value).withColumn(BROKEN, F.col(LINE).isNotNull() & ~F.col("blank"))
    seen = Observation()
    counted = rows.observe(
        seen,
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(F.col("blank"), 1)).alias("blank"),
        F.count(F.when(F.col(BROKEN), 1)).alias("broken"),
    )
    reason = F.when(F.col(BROKEN), broken_reason(F.col(LINE)))
    # Fields of a broken line may be parsed in part; they are not kept.
    fields = [F.when(~F.col(BROKEN), F.col(f"`{f.name}`")).alias(f.name) for f in schema.fields]
    out = counted.where(~F.col("blank")).select(*fields, LINE, reason.alias(REASON), BROKEN)
    out.write.partitionBy(BROKEN).parquet(path)
    counts = {k: int(seen.get[k]) for k in ("lines", "blank", "broken")}
    counts["good"] = counts["lines"] - counts["blank"] - counts["broken"]
    stored = StructType([*schema.fields, StructField(LINE, StringType()), StructField(REASON, StringType()), StructField(BROKEN, BooleanType())])
    table = spark.read.schema(stored).option("basePath", path).parquet(path)
    return SplitLines(
        table.where(~F.col(BROKEN)).select(*[f"`{f.name}`" for f in schema.fields]),
        table.where(F.col(BROKEN)).select(LINE, REASON),
        counts,
    )
