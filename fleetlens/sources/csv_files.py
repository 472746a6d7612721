"""Delimited-text raw tables (S-1, S-2).

Raw files are comma-delimited with one header line. The schema is fixed, so
nothing is inferred (no extra pass over the files). Several files load into
one table in a single scan; ``with_source_file`` adds the file each row came
from.

``read_table`` is permissive: a malformed field reads as NULL, which the
cleaning step then removes without a trace. ``parsed_lines`` keeps the trace:
every line either becomes a row or is rejected with its file, its text, a
reason and the columns at fault. A line is a record, as in the source's
delimited tables; quoted fields may hold the delimiter but no line end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SCHEMAS

REJECT_COLUMNS = ("table_name", "source_file", "line", "reason", "columns")
REASONS = ("repeated_header", "unclosed_quote", "too_few_fields", "too_many_fields", "bad_value")
HEADER = "header"           # a file's own header line; no reject
# A field that Spark's writer put in quotes; a backslash escapes within.
_QUOTED = r'"(?:[^"\\]|\\.)*"'


def read_table(spark: SparkSession, table: str, paths, delimiter: str = ",",
               header: bool = True, with_source_file: bool = False) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = (spark.read.schema(SCHEMAS[table])
               .option("header", header)
               .option("sep", delimiter)
               .option("mode", "PERMISSIVE")
               .csv(paths))
    if with_source_file:
        df = df.withColumn("source_file", F.input_file_name())
    return df


def write_table(df: DataFrame, path: str, delimiter: str = ",", mode: str = "overwrite") -> None:
    """Write a raw table as delimited text with a header line."""
    df.write.mode(mode).option("header", True).option("sep", delimiter).csv(path)


def _readable(text: Column, kind: T.DataType) -> Column:
    """True where a field's text is a value of its column's type, by the CSV
    reader's rules: an empty field is a NULL, blanks around a number are not."""
    if isinstance(kind, T.StringType):
        return F.lit(True)
    if isinstance(kind, T.IntegerType):
        return text.isNull() | (text.rlike(r"^[+-]?[0-9]+$") & text.try_cast("int").isNotNull())
    # in try_cast, blanks, "1d" and "infinity" would pass
    return text.isNull() | text.isin("NaN", "Inf", "-Inf") | (
        text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$") & text.try_cast("double").isNotNull())


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.IntegerType):
        return text.try_cast("int")
    infinite = F.when(text == "Inf", F.lit(float("inf"))).when(text == "-Inf", F.lit(float("-inf")))
    return F.coalesce(infinite, text.try_cast("double"))


def _unquoted(text: Column) -> Column:
    inner = F.regexp_replace(F.substr(text, F.lit(2), F.length(text) - 2), r'\\(["\\])', "$1")
    return F.when(text == "", F.lit(None)).when((F.length(text) > 1) & text.startswith('"') & text.endswith('"'), inner).otherwise(text)


def parsed_lines(spark: SparkSession, table: str, paths, delimiter: str = ",", header: bool = True) -> DataFrame:
    """Every line as a record: the table's columns, then ``source_file``,
    ``line``, ``reason`` (NULL where the line is a row) and ``columns`` (those
    with a bad value). A line that spells the column names is a header; files
    with and without one can be loaded together.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    schema = SCHEMAS[table]
    names = [f.name for f in schema.fields]
    lines = (spark.read.text(paths).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file"))
             .where(F.length("line") > 0))
    sep = "".join("\\" + c if not c.isalnum() else c for c in delimiter)
    quoted = F.col("line").contains('"')
    each = F.lit(f"{sep}({_QUOTED}[^{sep}]*|[^{sep}]*)")         # a field with the delimiter before it
    cut = F.when(quoted, F.regexp_extract_all(F.concat(F.lit(delimiter), F.col("line")), each, F.lit(1))).otherwise(F.split("line", sep, -1))
    # one row for each line, but a generator: what is computed from the fields
    # below then reads them, instead of each expression splitting the line again
    rows = lines.select(F.inline(F.array(F.struct(
        "line", "source_file", F.regexp_replace("line", _QUOTED, "").contains('"').alias("_open"),
        F.transform(cut, _unquoted).alias("_text")))))
    place = {f.name: i for i, f in enumerate(schema.fields)}
    field = lambda f: F.get("_text", F.lit(place[f.name]))
    rows = rows.withColumn("_fields", F.size("_text"))
    whole = (F.col("_fields") == len(names)) & ~F.col("_open")
    bad = F.array_compact(F.array(*[F.when(~_readable(field(f), f.dataType), F.lit(f.name)) for f in schema.fields]))
    rows = rows.withColumn("_bad", F.when(whole, bad))
    reason = (F.when(F.col("_open"), "unclosed_quote").when(F.col("_fields") < len(names), "too_few_fields")
              .when(F.col("_fields") > len(names), "too_many_fields").when(F.size("_bad") > 0, "bad_value"))
    if header:
        reason = F.when(F.col("line") == delimiter.join(names), HEADER).otherwise(reason)
    return rows.select(*[_typed(field(f), f.dataType).alias(f.name) for f in schema.fields], "source_file", "line",
                       reason.alias("reason"), F.when(F.size("_bad") > 0, F.col("_bad")).alias("columns"))


def accepted(parsed: DataFrame, table: str) -> DataFrame:
    """The rows of ``parsed_lines``."""
    return parsed.where(F.col("reason").isNull()).select(*SCHEMAS[table].names)


def rejected(parsed: DataFrame, table: str) -> DataFrame:
    """The rejects of ``parsed_lines`` (``REJECT_COLUMNS``). Of the header lines
    of a file, all but one are rejected as repeated."""
    lines = parsed.where(F.col("reason") != HEADER).select("source_file", "line", "reason", "columns")
    headers = parsed.where(F.col("reason") == HEADER).groupBy("source_file", "line").agg(F.count(F.lit(1)).alias("_n"))
    again = headers.where("_n > 1").select("source_file", "line", F.lit("repeated_header").alias("reason"),
                                           F.lit(None).cast("array<string>").alias("columns"),
                                           F.explode(F.sequence(F.lit(2), F.col("_n"))).alias("_copy")).drop("_copy")
    return lines.union(again).select(F.lit(table).alias("table_name"), "source_file", "line", "reason", "columns")
