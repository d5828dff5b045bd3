"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import contextlib
import pickle
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import materialize, scratch_path

__all__ = ["materialize", "materialize_small", "small_batches", "scratch_path", "table", "without", "id_remainder", "add_columns", "utf8", "share", "shared"]

# Python functions travel to the executors with their code, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__package__])


_BATCH = {  # rows handed to Python at once: long texts and sets must not add up
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


@contextlib.contextmanager
def small_batches(spark: SparkSession):
    """Small Arrow batches for what is run inside."""
    before = {k: spark.conf.get(k, None) for k in _BATCH}
    for k, v in _BATCH.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def materialize_small(df: DataFrame, stem: str = "stage") -> DataFrame:
    """``materialize`` with small batches."""
    with small_batches(df.sparkSession):
        return materialize(df, stem)


def share(spark: SparkSession, value):
    """Broadcast of a Python object whose class the executors may not know."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(held):
    """The object of ``share``, unpacked once per task."""
    return pickle.loads(held.value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` less the columns an operator is about to add (any letter case)."""
    lower = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in lower])


def id_remainder(column, parts: int):
    """Remainder of the CRC-32 of an id written as text; 0 for a null id."""
    return F.coalesce(F.pmod(F.crc32(column.cast("string")), F.lit(parts)), F.lit(0))


def utf8(column: pa.Array) -> list:
    """The texts of an Arrow column as UTF-8 bytes, nulls as None."""
    return column.cast(pa.binary()).to_pylist()


def add_columns(df: DataFrame, added: list[tuple[str, T.DataType, pa.DataType]], start, reads: list[str]) -> DataFrame:
    """``df`` with columns computed batch by batch in Python, rows untouched.

    ``start()`` runs once per task and returns a function from the Arrow
    columns named in ``reads`` to one list per added column. An input column
    whose name is taken by an added one is replaced.
    """
    rest = without(df, [name for name, _, _ in added])
    schema = T.StructType(rest.schema.fields + [T.StructField(n, t) for n, t, _ in added])
    names = rest.columns + [n for n, _, _ in added]
    kinds = [kind for _, _, kind in added]

    def run(batches):
        work = start()
        for batch in batches:
            lists = work(*[batch.column(batch.schema.get_field_index(c)) for c in reads])
            new = [pa.array(values, kind) for values, kind in zip(lists, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=names)

    return rest.mapInArrow(run, schema)
