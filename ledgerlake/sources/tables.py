"""Readers for the parquet tables and DuckDB view registration for oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Parquet scan; naming the columns here keeps ReadSchema minimal even
    before Catalyst prunes (and documents what each operator touches)."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for n in names:
        read(spark, sf_dir, n).createOrReplaceTempView(n)


#: A dimension is broadcast if its counted rows times the bytes of its columns stay below this.
BROADCAST_BYTES = 32 << 20
_ROWS: dict[tuple[str, str], int] = {}


def row_count(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Rows of a table, from the Parquet footers, counted once per session."""
    key = (spark.sparkContext.applicationId, table_path(sf_dir, name))
    if key not in _ROWS:
        _ROWS[key] = spark.read.parquet(key[1]).count()
    return _ROWS[key]


def small(df: DataFrame, sf_dir: str, name: str, row_bytes: int) -> DataFrame:
    """``df``, which has no more rows than table ``name``, with a broadcast hint if
    that many rows of ``row_bytes`` are few; a larger one is joined by shuffling."""
    return F.broadcast(df) if row_count(df.sparkSession, sf_dir, name) * row_bytes <= BROADCAST_BYTES else df
