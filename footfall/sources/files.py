"""Batch readers."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from footfall.functions.clock import in_date_range
from footfall.schemas import PARTITIONED_BY, RAW, TABLES

REJECTED = "rejected_line"


def _text_rows(spark: SparkSession, path: str) -> DataFrame:
    # Read as text and without column pruning: whether a row is well formed must not depend on
    # the columns a query asks for.
    schema = StructType([StructField(c, StringType()) for c in (*RAW.names, REJECTED)])
    return (
        spark.read.option("header", False)
        .option("columnPruning", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED)
        .schema(schema)
        .csv(path)
    )


def _typed() -> list[Column]:
    return [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RAW]


def _well_formed() -> Column:
    """Exactly the five fields, each of its type or empty."""
    readable = [F.col(f.name).isNull() | F.col(f.name).try_cast(f.dataType).isNotNull() for f in RAW]
    return reduce(and_, readable, F.col(REJECTED).isNull())


def load_raw(spark: SparkSession, path: str, drop_malformed: bool = False) -> DataFrame:
    """Headerless five-column event CSV with the declared schema, never inferred.

    Fields that do not parse become null (and are removed by cleaning), or with
    ``drop_malformed`` every row is dropped whose fields are not exactly the five expected.
    """
    if drop_malformed:
        return _text_rows(spark, path).filter(_well_formed()).select(*_typed())
    return spark.read.option("header", False).schema(RAW).csv(path)


def split_rejects(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The well-formed rows, and (rejected_line, reason) of the lines that are not.

    The reason is ``fields`` for a line of more or fewer than five fields, else the names of the
    fields that are not of their type.
    """
    lines = _text_rows(spark, path)
    fields = F.concat_ws(",", *(F.coalesce(F.col(c), F.lit("")) for c in RAW.names))
    unreadable = F.concat_ws(
        ",",
        *(
            F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), f.name)
            for f in RAW
        ),
    )
    rejected = lines.filter(~_well_formed()).select(
        F.coalesce(F.col(REJECTED), fields).alias(REJECTED),
        F.when(F.col(REJECTED).isNotNull(), "fields").otherwise(unreadable).alias("reason"),
    )
    return lines.filter(_well_formed()).select(*_typed()), rejected


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name.replace('.', '/')}"


def read_layer(
    spark: SparkSession,
    name: str,
    root: str | None = None,
    start: str | None = None,
    end: str | None = None,
    schema: StructType | None = None,
    prefix: str = "",
) -> DataFrame:
    """A stored table: from the catalog, or from the warehouse folder ``root``.

    Given a day range, a table partitioned by day is read only for those days. The declared
    schema (or ``schema``) is used, so the partition column stays a string and no file is opened to infer it.
    """
    schema = schema or TABLES[name]
    if root is None:
        df = spark.table(prefix + name).select(*schema.names)
    else:
        df = spark.read.schema(schema).parquet(table_path(root, name))
    return in_date_range(df, start, end) if "event_date" in PARTITIONED_BY.get(name, ()) else df


def read_result_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """An exported result file, with the types of table ``name``."""
    return spark.read.option("header", True).schema(TABLES[name]).csv(path)
