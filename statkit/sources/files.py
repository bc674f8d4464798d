"""Scans of landed files. Everything is read as text and cast explicitly.

Splittable inputs use Spark's own readers; a file is one task only where its format leaves no other way (members of archives).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statkit.sources import archives


def delimited(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """A delimited scan with every column a string; an empty field is the empty string."""
    reader = spark.read.options(sep=sep, encoding=encoding, emptyValue="", nullValue="\x00", header=str(columns is None).lower())
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def available(df: DataFrame, want: Sequence[str]) -> DataFrame:
    """Those of the wanted columns that there are."""
    return df.select(*[c for c in want if c in df.columns])


def reconciled(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, list[str], list[str]]:
    """df in the modelled columns (missing ones null), the unknown columns that were dropped and the missing ones."""
    known = schema.fieldNames()
    shown = [F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*shown), [c for c in df.columns if c not in known], [c for c in known if c not in df.columns]


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; missing columns are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def decoded_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, line) of text files in UTF-8, or else in Latin-1 (S2); number counts a file's lines from 0.

    Files are split as Spark's text reader does, which keeps their bytes as they are. One row for each block (a file's part
    that one task reads) tells how many lines it has and whether all are valid; from these follow the encoding of the whole
    file and the number of lines before a block. Both reads number a block's lines in the same order.
    """
    raw = spark.read.option("lineSep", "\n").text(path)
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("at"))
    blocks = raw.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"), F.bool_and(F.is_valid_utf8("value")).alias("valid"))
    whole = Window.partitionBy("file")
    before = F.sum("n").over(whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("file", "block", "first", F.coalesce(before, F.lit(0)).alias("before"), F.bool_and("valid").over(whole).alias("utf"))
    text = F.when(F.col("utf"), F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), "ISO-8859-1"))
    rows = raw.join(blocks, ["file", "block"])
    return rows.select("file", (F.col("before") + F.col("at") - F.col("first")).alias("number"), F.regexp_replace(text, "\\r$", "").alias("line"))


def repaired_fields(line: Column, n: int, sep: str = ",") -> Column:
    """n fields of a ragged line: surplus ones go back into the last, a short line is padded with nulls."""
    parts = F.split(line, f"\\Q{sep}\\E", -1)
    last = F.array_join(F.slice(parts, n, F.greatest(F.size(parts) - n + 1, F.lit(1))), sep)
    return F.when(F.size(parts) >= n, F.concat(F.slice(parts, 1, n - 1), F.array(last))).otherwise(F.concat(parts, F.array_repeat(F.lit(None).cast("string"), n - F.size(parts))))


def below_header(lines: DataFrame, names: Sequence[str], first: int = 20, sep: str = ",") -> DataFrame:
    """Lines after each file's header: the first of its `first` lines with one of the names in a cell.

    lines: (file, number, line). Files without a header give no rows.
    """
    cells = F.transform(F.split("line", f"\\Q{sep}\\E", -1), lambda c: F.lower(F.trim(c)))
    heads = lines.filter((F.col("number") < first) & F.exists(cells, lambda c: c.isin(*[n.lower() for n in names])))
    heads = heads.groupBy("file").agg(F.min("number").alias("head"))
    return lines.join(heads, "file").filter("number > head").drop("head")


def member_lines(spark: SparkSession, path: str, expected: str, pattern: str = "*", encoding: str = "utf-8") -> DataFrame:
    """(file, member, number, line) of one member of each zip archive: the exact name, else of those that fit the newest edition (S3).

    As archives.archive_lines; an archive without such a member is an error.
    """
    return archives.archive_lines(spark, path, expected, pattern, encoding=encoding)


def name_period(name: Column) -> dict[str, Column]:
    """Periods that a file's name holds: year and quarter (..._2024_trim3), or a date (dd-mm-yyyy)."""
    part = lambda p, i: F.regexp_extract(name, p, i).try_cast("int")
    quarter = "(?i)((?:19|20)[0-9]{2})[_-]?(?:trim|q|t)_?([1-4])"
    return {
        "year": part(quarter, 1),
        "quarter": part(quarter, 2),
        "cut": F.try_to_date(F.regexp_extract(name, "([0-9]{2}-[0-9]{2}-[0-9]{4})", 1), "dd-MM-yyyy"),
    }


def sheet_rows(df: DataFrame, columns: Sequence[str], key: str = "^[0-9]{5}$") -> DataFrame:
    """A landed sheet with positional names; only rows whose first cell looks like a key."""
    out = df.toDF(*columns)
    return out.filter(F.col(columns[0]).rlike(key))


def grouped_lookup(df: DataFrame, group: str, key: str, value: str) -> DataFrame:
    """(group, map of key to value)."""
    return df.groupBy(group).agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct(key, value)))).alias("entries"))
