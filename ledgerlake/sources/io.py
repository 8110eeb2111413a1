"""Sources and sinks: raw/typed CSV, nested JSON, gold writers, JSON
reports and optional sources.  Paths are whatever the cluster storage names
(a shared file system or object store); nothing here uses driver-local
files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_raw(spark: SparkSession, path: str, cols: list[str], encoding: str = "UTF-8") -> DataFrame:
    """Header CSV read as dirty text: every column a string (no inference),
    so cleaning sees exactly what the extract holds."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in cols])
    return (spark.read.schema(schema).option("header", True).option("encoding", encoding)
            .option("mode", "PERMISSIVE").csv(path))


def read_typed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Typed CSV (UTF-8, comma, quoted, header promoted, en-US numbers)."""
    return (spark.read.schema(schema).option("header", True).option("quote", '"')
            .option("mode", "PERMISSIVE").csv(path))


def read_json_series(spark: SparkSession, path: str, scale: float = 100.0) -> DataFrame:
    """Nested document ``results[0].detalle[] = {fecha, valor}`` -> rows
    (date, value / scale)."""
    doc = spark.read.option("multiLine", True).json(path)
    det = doc.select(F.explode(F.element_at("results", 1)["detalle"]).alias("d"))
    return det.select(F.to_date("d.fecha").alias("fecha"), (F.col("d.valor") / scale).alias("valor"))


def json_map_to_rows(df: DataFrame, col: str, value_schema: str, key_name: str = "clave") -> DataFrame:
    """A JSON text column holding a dict keyed by segment -> one row per key."""
    m = F.from_json(col, f"map<string,{value_schema}>")
    return df.select(F.explode(m).alias(key_name, "v")).select(key_name, "v.*")


def write_gold(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write a curated table (overwrite).  Partitioned by month where given,
    so later reads prune partitions."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_json_report(df: DataFrame, path: str) -> None:
    """One JSON document per row (``to_json(struct(*))``), as text."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def read_optional(spark: SparkSession, path: str, reader, required: bool = False):
    """Missing source -> None (skipped); a required one raises."""
    if exists(spark, path):
        return reader(path)
    if required:
        raise FileNotFoundError(path)
    return None


def read_json_aligned(spark: SparkSession, path: str, maps: list[str], key_name: str = "fecha", value_type: str = "double") -> DataFrame:
    """A document with several maps under one set of keys (``{"a": {k: v}, ...}``)
    as one table: a row per key, a column per map, null where a map lacks the key."""
    schema = T.StructType([T.StructField(m, T.MapType(T.StringType(), T.StructType.fromDDL(f"v {value_type}")["v"].dataType)) for m in maps])
    doc = spark.read.schema(schema).option("multiLine", True).json(path)
    out = None
    for m in maps:
        rows = doc.select(F.explode(m).alias(key_name, m))
        out = rows if out is None else out.join(rows, key_name, "full_outer")
    return out
