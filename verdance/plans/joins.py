"""Join shapes that hold when the small side grows and when keys are hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20


def fits(
    dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Whether a stored dimension table is within the bounds on rows and bytes.

    Reads no more than one row beyond the bound on rows; a row's bytes are
    those of its JSON text.
    """
    size = F.length(F.to_json(F.struct("*"))).alias("size")
    found = dim.select(size).limit(max_rows + 1).agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).first()
    return found["rows"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a missing key equals a missing key, so no row is lost to one."""
    named = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return left.join(named, same, how).drop(*[f"_of_{k}" for k in keys])


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    bounded: bool | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Join a fact table with a dimension table, missing keys alike.

    The dimension is broadcast if its size is bounded: either the caller knows
    why (``bounded=True``), or its counted rows and bytes say so.  Else it is
    a shuffled join, whose hot partitions Spark splits at run time.
    """
    if bounded is None:
        bounded = fits(dim, max_rows)
    return null_safe_join(fact, F.broadcast(dim) if bounded else dim, keys, how)
