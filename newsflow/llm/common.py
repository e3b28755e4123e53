"""Helpers shared by the operators of this package."""

from __future__ import annotations

import string
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.session import shared_folder

ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
    "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string()),
}


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def materialised(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage and survives lost executors."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, open_task: Callable, schema: dict[str, str]) -> DataFrame:
    """Run Python over Arrow batches.

    ``open_task()`` runs once per task and returns a function from the lists of a
    batch, in the order of ``df``'s columns, to the output lists, in that of ``schema``.
    """
    out = pa.schema([(name, ARROW[kind]) for name, kind in schema.items()])

    def run(batches):
        work = open_task()
        for batch in batches:
            columns = work(*(column.to_pylist() for column in batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return df.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in schema.items()))


def filter_batches(df: DataFrame, open_task: Callable, column: str) -> DataFrame:
    """The rows of ``df``, all columns as they are, for which a Python function holds.

    ``open_task()`` runs once per task and returns a function from the values of
    ``column`` to a list of booleans. Nothing is shuffled or joined.
    """

    def run(batches):
        keep = open_task()
        for batch in batches:
            mask = keep(batch.column(batch.schema.names.index(column)).to_pylist())
            yield batch.filter(pa.array(mask, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
