"""Stored tables of the layers, and result export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..order import reset_order
from ..schemas import LAYERS
from ..session import delete_folder


def database(layer: str, tag: str = "") -> str:
    return f"tidemark_{layer}{'_' + tag if tag else ''}"


def write_table(
    df: DataFrame,
    layer: str,
    name: str,
    root: str,
    mode: str = "overwrite",
    partition_by: str | None = None,
    bucket_by: tuple[int, str] | None = None,
    tag: str = "",
) -> DataFrame:
    """Store ``df`` as Parquet table ``name`` of ``layer`` under ``root``.

    ``mode="append"`` adds rows to a table the catalog knows; it never creates one.
    A partitioned table is rebalanced by its partition column first: adaptive
    execution merges small partitions and splits a large one, so the file count
    stays low without one task writing a whole busy month. A bucketed table is
    shuffled by its bucket column into one file per bucket; whoever runs the
    cluster chooses the number.
    """
    spark = df.sparkSession
    db = database(layer, tag)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    if mode == "append" and not spark.catalog.tableExists(f"{db}.{name}"):
        raise ValueError(f"cannot append: no table {db}.{name}")
    if partition_by:
        df = df.hint("rebalance", partition_by)
    if bucket_by:
        df = df.repartition(*bucket_by)
    writer = df.write.mode(mode).format("parquet").option("path", f"{root.rstrip('/')}/{layer}/{name}")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.saveAsTable(f"{db}.{name}")
    return spark.table(f"{db}.{name}")


def read_table(spark: SparkSession, layer: str, name: str, tag: str = "") -> DataFrame:
    return spark.table(f"{database(layer, tag)}.{name}")


def reset_layer(spark: SparkSession, layer: str, tag: str = "", root: str | None = None) -> None:
    """Drop the layer's tables, those that refer to others first, and its database. It validates nothing.

    The tables are external; with ``root`` their files go too.
    """
    db = database(layer, tag)
    if spark.catalog.databaseExists(db):
        for name in [t for t in reset_order() if t in LAYERS[layer]]:
            spark.sql(f"DROP TABLE IF EXISTS {db}.{name}")
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    if root:
        delete_folder(spark, f"{root.rstrip('/')}/{layer}")


def publish(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False) -> None:
    """Export a result for a dashboard, as many part files or, if asked for, as one.

    ``single_file`` is for results that are small by design, one row per segment:
    it sends them through one task. What it does never depends on the row count.
    """
    if single_file:
        df = df.repartition(1)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
