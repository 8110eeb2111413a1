"""Helpers shared by the operators: table access, intermediate tables in the
shared folder and bounded text batches for Arrow functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.session import materialise, release, ship_package

#: Intermediate tables: written into the shared folder and read back, so a lost
#: executor costs no recomputation; ``release`` deletes a session's.
written = materialise
__all__ = ["map_texts", "release", "ship", "table", "text_batches", "with_texts", "written"]

#: Bytes of text that an Arrow function handles at once (one longer text is a batch of its own).
TEXT_BATCH = 4 << 20

#: Bytes of an Arrow batch on its way to a Python worker; a session's larger bound is lowered.
ARROW_BYTES = 8 << 20
_ARROW_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Prepare a session: bound the bytes of its Arrow batches, and send this
    package to the executors, once per application, so that its functions can be
    loaded there wherever the driver found it."""
    bound = spark.conf.get(_ARROW_SETTING, "64m")
    if not bound.removesuffix("b").isdigit() or not 0 < int(bound.removesuffix("b")) <= ARROW_BYTES:
        spark.conf.set(_ARROW_SETTING, str(ARROW_BYTES))
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    ship(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def text_batches(batches: Iterator[pa.RecordBatch], column: int = 1,
                 limit: int = TEXT_BATCH) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def map_texts(df: DataFrame, id_col: str, text_col: str, schema: str,
              function: Callable[[list], dict], as_bytes: bool = False) -> DataFrame:
    """Apply ``function(texts) -> {column: values}`` to bounded batches of one
    text column.  The result has the id, with its own type, and the columns of
    ``schema``; other columns of ``df`` take no part, whatever their names."""
    ship(df.sparkSession)
    id_type = df.schema[id_col].dataType.simpleString()
    source = df.select(F.col(id_col).alias("_id"),
                       F.col(text_col).cast("binary" if as_bytes else "string").alias("_text"))

    def run(batches):
        for part in text_batches(batches):
            out = function(part.column(1).to_pylist())
            arrays = [part.column(0)] + [v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v)
                                         for v in out.values()]
            yield pa.RecordBatch.from_arrays(arrays, names=["_id", *out])

    return source.mapInArrow(run, f"_id {id_type}, {schema}").withColumnRenamed("_id", id_col)


def with_texts(df: DataFrame, text_col: str, schema: str, function: Callable[[list], dict], as_bytes: bool = False) -> DataFrame:
    """``df`` with the columns of ``schema`` put behind its own, from
    ``function(texts)``.  Rows keep all their columns and are not moved."""
    ship(df.sparkSession)
    added = StructType.fromDDL(schema)
    if clash := set(df.columns) & set(added.names):
        raise ValueError(f"columns {sorted(clash)} are there already")
    place = df.columns.index(text_col)

    def run(batches):
        for part in text_batches(batches, place):
            texts = part.column(place)
            out = function((texts.cast(pa.binary()) if as_bytes else texts).to_pylist())
            arrays = [v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v) for v in out.values()]
            yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=[*part.schema.names, *out])

    return df.mapInArrow(run, StructType([*df.schema.fields, *added.fields]))
