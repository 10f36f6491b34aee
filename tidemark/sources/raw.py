"""Landing: delimited text files into all-string frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_COLUMNS

MALFORMED = "_malformed"


def _parsed(spark: SparkSession, table: str, path: str | list[str], breaks: str) -> DataFrame:
    """All records with their own column names; ``_malformed`` holds the text of those that do not fit the header."""
    if breaks not in ("quoted", "escaped"):
        raise ValueError(f"unknown treatment of line breaks {breaks!r}")
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("multiLine", breaks == "quoted")
    )
    # one line is read for the names; every file's header is then held against them
    header = reader.csv(path).columns
    missing = [c for c in RAW_COLUMNS[table] if c not in header]
    if missing:
        raise ValueError(f"{table}: the header lacks {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, MALFORMED)])
    return (
        reader.schema(schema)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", False)
        .csv(path)
    )


def _some(table: str) -> Column:
    """Always true. Spark refuses plans that read nothing of a text file but its malformed records."""
    return F.length(F.coalesce(F.col(RAW_COLUMNS[table][0]), F.lit(""))) >= 0


def read_raw(spark: SparkSession, table: str, path: str | list[str], breaks: str = "quoted") -> DataFrame:
    """Read the CSV extract of one table. Every column stays text, blanks are kept.

    Columns are bound by the names in the header, in any order; further columns
    are left out, a missing one raises. Records with too few or too many fields
    are not read, see ``raw_rejects``. ``breaks`` says how a line break inside a
    field is written: ``"quoted"``, as it is, which makes each file one task, or
    ``"escaped"``, as ``land_raw`` does it, which lets Spark split files. A text
    file knows no NULL: an empty field is the empty text.
    """
    rows = _parsed(spark, table, path, breaks).where(F.col(MALFORMED).isNull() | ~_some(table))
    text = _broken if breaks == "escaped" else (lambda c: c)
    return rows.select(*[text(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in RAW_COLUMNS[table]])


def raw_rejects(spark: SparkSession, table: str, path: str | list[str], breaks: str = "quoted") -> DataFrame:
    """``record``: the text of every record that ``read_raw`` leaves out."""
    rows = _parsed(spark, table, path, breaks).where(F.col(MALFORMED).isNotNull() & _some(table))
    return rows.select(F.col(MALFORMED).alias("record"))


def ingest_raw(spark: SparkSession, folder: str, breaks: str = "quoted") -> dict[str, DataFrame]:
    """All five extracts of a folder laid out as ``<folder>/<table>/*.csv``."""
    return {table: read_raw(spark, table, f"{folder.rstrip('/')}/{table}", breaks) for table in RAW_COLUMNS}


def land_raw(df: DataFrame, path: str) -> None:
    """Write a raw frame as CSV files with one record on each line, for ``read_raw(..., breaks="escaped")``."""
    (
        df.select(*[_on_one_line(F.col(c)).alias(c) for c in df.columns])
        .write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _on_one_line(c: Column) -> Column:
    escaped = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(escaped, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _broken(c: Column) -> Column:
    """Undo ``_on_one_line``: a pair of backslashes stands for one and hides what follows it."""
    parts = F.split(c, r"\\\\", -1)
    back = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(back, "\\")
