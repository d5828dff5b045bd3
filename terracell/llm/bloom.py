"""Fixed-size Bloom filters over 64-bit keys: a bound on what is broadcast, at any number of keys."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

BITS = 1 << 26  # 8 MB; a fuller filter passes more rows, never fewer
PROBES = 2


def build(keys: DataFrame, column: str) -> np.ndarray:
    """Bit words of the filter, summed up on the executors; at most BITS / 64 words reach the driver."""
    spots = F.array(*[F.pmod(F.xxhash64(F.col(column), F.lit(i)), F.lit(BITS)) for i in range(PROBES)])
    words = (
        keys.select(F.explode(spots).alias("s")).groupBy((F.col("s") / 32).cast("int").alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(s % 32 AS INT))")).alias("b"))
    )
    out = np.zeros(BITS // 32, dtype="uint32")
    got = words.toArrow()
    out[got["w"].to_numpy()] = got["b"].to_numpy().astype("uint32")
    return out


def passes(bits: np.ndarray, spots: np.ndarray) -> np.ndarray:
    """Whether all probes of each row are set; ``spots`` has a column per probe."""
    return ((bits[spots >> 5] >> (spots & 31).astype("uint32")) & 1).all(axis=1)


def spots_of(column):
    """The probe positions of a key, to be computed by Spark next to the rows."""
    return F.array(*[F.pmod(F.xxhash64(column, F.lit(i)), F.lit(BITS)) for i in range(PROBES)])
