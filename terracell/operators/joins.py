"""Joins of a large table with a per-key lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import BROADCAST_BYTES, SALTS
from ..session import materialize


_FIXED = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}


def held_bytes(df: DataFrame) -> int:
    """Bytes the rows of ``df`` take, long values counted one by one."""
    def size(field):
        kind = field.dataType.simpleString()
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        if kind.startswith(("array", "map", "struct")):
            return F.coalesce(F.octet_length(F.to_json(F.struct(F.col(field.name)))), F.lit(0)) + 16
        return F.lit(_FIXED.get(kind, 16 if kind.startswith("decimal") else 8))

    total = F.lit(8)
    for field in df.schema.fields:
        total = total + size(field)
    return df.agg(F.sum(total)).first()[0] or 0


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    extra=None,
    limit: int = BROADCAST_BYTES,
    stored: bool = False,
) -> DataFrame:
    """Join ``facts`` to ``lookup``, whose rows per key are few.

    The lookup is stored once and its bytes are added up. Up to ``limit`` bytes
    it is broadcast, so the large side is not moved at all. Beyond that both
    sides are shuffled, with the facts of each key dealt out over SALTS
    sub-keys and the lookup repeated for each, so no key ends up in one task.
    ``extra`` is a further join condition over the columns of both sides.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"lookup_join does not support {how!r}")
    lookup = lookup if stored else materialize(lookup, "lookup")
    if held_bytes(lookup) <= limit:
        lookup, keys = F.broadcast(lookup), list(on)
    else:
        mix = F.xxhash64(*[F.col(c) for c in facts.columns if c not in on] or [F.lit(0)])
        facts = facts.withColumn("_salt", F.pmod(mix, F.lit(SALTS)).cast("int"))
        lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        keys = [*on, "_salt"]
    if extra is None:
        return facts.join(lookup, keys, how).drop("_salt")
    side = lookup.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in lookup.columns])
    test = extra
    for k in keys:
        test = (F.col(k) == F.col(f"_r_{k}")) & test
    return facts.join(side, test, how).drop("_salt", *[f"_r_{k}" for k in keys])
