"""Layered Parquet tables, in the catalog or in a plain warehouse folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.schemas import LAYERS, PARTITIONED_BY, conform, create_table_ddl
from footfall.sources.files import table_path


def create_databases(spark: SparkSession, prefix: str = "", root: str | None = None) -> None:
    """A database per layer, in the catalog's warehouse or below the folder ``root``.

    ``prefix`` goes before the layers' names, so that several warehouses fit in one catalog.
    """
    for layer in LAYERS:
        at = f" LOCATION '{root.rstrip('/')}/{layer}'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}{at}")


def create_table(spark: SparkSession, name: str, replace: bool = True, prefix: str = "") -> None:
    """Create a registered table, empty and typed; drops an existing one if ``replace``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{name.split('.')[0]}")
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{name}")
    spark.sql(create_table_ddl(name, prefix))


def save(
    df: DataFrame,
    name: str,
    root: str | None = None,
    replace_days_only: bool = False,
    schema: StructType | None = None,
    prefix: str = "",
) -> None:
    """Overwrite a registered table with ``df``, cast to the table's types (or to ``schema``).

    A table partitioned by day is rebalanced on the day before it is written: the shuffle gives
    few files per day, and adaptive execution splits a large day over many tasks and files
    instead of sending it through one. ``replace_days_only`` replaces just the days that ``df``
    contains, so one day can be run again; otherwise the whole table is replaced.
    """
    rows = conform(df, schema or name)
    parts = PARTITIONED_BY.get(name, ())
    if parts:
        rows = rows.hint("rebalance", *(F.col(p) for p in parts))
    spark = df.sparkSession
    table = prefix + name
    if root is None and replace_days_only and spark.catalog.tableExists(table):
        # an insert takes the overwrite mode from the table, where it was set on creation
        rows.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
        return
    dynamic = root is None or replace_days_only
    writer = (
        rows.write.format("parquet")
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .mode("overwrite")
    )
    if parts:
        writer = writer.partitionBy(*parts)
    if root is None:
        writer.saveAsTable(table)
    else:
        writer.save(table_path(root, name))


def list_tables(spark: SparkSession, prefix: str = "") -> DataFrame:
    """The tables of all layers that exist: layer, table."""
    present = {d.name for d in spark.catalog.listDatabases()}
    rows = [
        (layer, table.name)
        for layer in LAYERS
        if prefix + layer in present
        for table in spark.catalog.listTables(prefix + layer)
        if not table.isTemporary
    ]
    return spark.createDataFrame(rows, "layer string, table string")


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Column names, types and whether they partition the table."""
    rows = [(c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(name)]
    return spark.createDataFrame(rows, "col_name string, data_type string, is_partition boolean")
