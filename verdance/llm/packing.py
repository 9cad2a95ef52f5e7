"""Conflict-constrained best-fit packing of documents into training sequences.

Documents are dealt to shards of about ``SHARD_ROWS`` by a hash of the row, so
hot sources and clusters are spread, and each shard is packed apart: largest
first, into the bin with the least sufficient room that has no conflict.  Two
pieces conflict if they share a source or a duplicate cluster.

A bin carries bitmaps of the sources and clusters it holds.  Bins stand in
order of room left; the search starts at the tightest one that is large enough
and goes on to the next until one has no conflict.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.llm.words import GAP, word_list

CAPACITY = 2048
SHARD_ROWS = 8192
_BITS = 32
_MASK = (1 << _BITS) - 1


def _bitmaps(values: Sequence) -> list[int]:
    """A bit per value that occurs twice or more; others, and missing ones, conflict with nothing."""
    often = [v for v, n in Counter(values).items() if n > 1 and v is not None]
    bit = {v: 1 << i for i, v in enumerate(often)}
    return [bit.get(v, 0) for v in values]


def best_fit(sizes: Sequence[int], sources: Sequence, clusters: Sequence, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(row, piece, bin, offset, size)`` of rows given in order of packing.

    A row larger than a bin is cut into full pieces, each a bin of its own, and
    a rest that is packed like any other.
    """
    source_bits, cluster_bits = _bitmaps(sources), _bitmaps(clusters)
    pieces, rests, bins = [], [], 0
    for row, size in enumerate(sizes):
        full, rest = divmod(size, capacity)
        if full and not rest:
            full, rest = full - 1, capacity
        for piece in range(full):
            pieces.append((row, piece, bins, 0, capacity))
            bins += 1
        rests.append((rest, row, full))
    rests.sort(key=lambda r: (-r[0], r[1]))
    room: list[int] = []  # room left and bin, in ascending order
    held_sources: dict[int, int] = {}
    held_clusters: dict[int, int] = {}
    for size, row, piece in rests:
        s, c = source_bits[row], cluster_bits[row]
        at = bisect_left(room, size << _BITS)
        while at < len(room):
            b = room[at] & _MASK
            if not (held_sources[b] & s or held_clusters[b] & c):
                break
            at += 1
        if at < len(room):
            left = room.pop(at) >> _BITS
            held_sources[b] |= s
            held_clusters[b] |= c
        else:
            b, left = bins, capacity
            bins += 1
            held_sources[b], held_clusters[b] = s, c
        pieces.append((row, piece, b, capacity - left, size))
        insort(room, (left - size) << _BITS | b)
    return pieces


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Places of all pieces: ``doc_id, piece, size, bin_id, start``.

    ``docs`` has ``doc_id, size, source, cluster``.  Sizes below one count as
    one, missing ones too; a missing source or cluster conflicts with nothing.
    Rows that repeat a ``doc_id`` are packed each.  ``bin_id`` is unique over
    all shards, and ``start`` is the piece's first position in its bin.
    """
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.greatest(F.coalesce(F.col("size").cast("long"), F.lit(1)), F.lit(1)).alias("size"),
        F.col("source").cast("string").alias("source"),
        F.col("cluster").cast("long").alias("cluster"),
    )
    shards = max(1, math.ceil(plain.count() / shard_rows))

    def pack_shard(key, table):
        import pyarrow as pa

        table = table.sort_by([("size", "descending"), ("doc_id", "ascending"), ("source", "ascending"), ("cluster", "ascending")])
        ids = table.column("doc_id").to_pylist()
        placed = best_fit(
            table.column("size").to_pylist(), table.column("source").to_pylist(),
            table.column("cluster").to_pylist(), capacity,
        )
        row, piece, bin_, start, size = zip(*placed)
        shard = key[0].as_py() << _BITS
        return pa.table(
            {
                "doc_id": pa.array([ids[r] for r in row], pa.int64()),
                "piece": pa.array(piece, pa.int64()),
                "size": pa.array(size, pa.int64()),
                "bin_id": pa.array([shard + b for b in bin_], pa.int64()),
                "start": pa.array(start, pa.int64()),
            }
        )

    shard = F.pmod(F.xxhash64("doc_id", "size", "source", "cluster"), F.lit(shards)).cast("long")
    return (
        plain.withColumn("shard", shard)
        .groupBy("shard")
        .applyInArrow(pack_shard, "doc_id long, piece long, size long, bin_id long, start long")
    )


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source, cluster``: words and an end mark, and equal words as a cluster.

    Texts whose words are equal up to case are one cluster; texts without words have none.
    """
    words = F.size(word_list(F.col("text")))
    shape = F.trim(F.regexp_replace(F.lower("text"), GAP, " "))
    return docs.select(
        "doc_id",
        (words + 1).cast("long").alias("size"),
        "source",
        F.when(shape != "", F.xxhash64(shape)).alias("cluster"),
    )


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(sized(spark.read.parquet(f"{sf_dir}/documents.parquet")))
