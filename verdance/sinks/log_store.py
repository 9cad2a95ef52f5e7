"""The vegetation log in documents of bounded size, of which an update rewrites only some.

Entries are dealt to buckets by a hash of area and scene, so an entry of a scene
that is processed again finds the earlier one in its own bucket.  A bucket holds
documents of at most ``ENTRIES`` entries of one area; the areas of a log, and a
log that is mostly one area, are spread over all buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verdance import schemas
from verdance.operators.veglog import COLUMNS
from verdance.plans.ordering import first_rows
from verdance.streaming.blocks import BLOCK, Blocks

BUCKETS = 256
ENTRIES = 4096
#: Versions after which blocks that nothing names are removed.
VACUUM_EVERY = 16


def log_store(spark: SparkSession, base: str) -> Blocks:
    return Blocks(spark, base, ("documents",))


def documents_of(entries: DataFrame, size: int = ENTRIES) -> DataFrame:
    """``_part, aoi_id, document, first_seq, last_seq, scenes``: entries of a bucket and area by arrival.

    Entries are cut by a number within their bucket and area, of which a bucket
    has a small share even if the log is one area's.
    """
    order = W.partitionBy(BLOCK, "aoi_id").orderBy("seq", "scene_id")
    entry = F.struct(*[c for c in COLUMNS if c != "aoi_id"])
    numbered = entries.withColumn("document", F.floor((F.row_number().over(order) - 1) / size).cast("int"))
    return numbered.groupBy(BLOCK, "aoi_id", "document").agg(
        F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.sort_array(F.collect_list(
            F.struct(F.col("seq").alias("at"), entry.alias("entry"))
        )).alias("scenes"),
    ).withColumn("scenes", F.transform("scenes", lambda s: s["entry"]))


def entries_of(documents: DataFrame) -> DataFrame:
    return documents.select("aoi_id", F.inline("scenes")).select(*COLUMNS)


def upsert_log(
    entries: DataFrame, batch_id: int, base: str, buckets: int = BUCKETS, size: int = ENTRIES
) -> Blocks:
    """Adds entries; of entries of one scene of an area the one that arrived last stays.

    Only the buckets of the batch are read and written.  The number of buckets
    belongs to the store and must not change.
    """
    store = log_store(entries.sparkSession, base)
    bucket = F.pmod(F.xxhash64("aoi_id", "scene_id"), F.lit(buckets)).cast("long")

    def make(before: DataFrame | None, new: DataFrame) -> dict[str, DataFrame]:
        both = new.select(*COLUMNS)
        both = both if before is None else both.unionByName(entries_of(before))
        newest = first_rows(both, ["aoi_id", "scene_id"], [F.col("seq").desc(), F.col("ndvi_mean").desc_nulls_last()], 1)
        return {"documents": documents_of(newest.withColumn(BLOCK, bucket), size)}

    store.advance(entries, batch_id, bucket, make)
    if (batch_id + 1) % VACUUM_EVERY == 0:
        store.vacuum()
    return store


def read_log_store(spark: SparkSession, base: str, aoi_id=None) -> DataFrame:
    """The stored log; the entries of one area by a filter that reaches the documents' scan.

    A store that was never written is an empty log.
    """
    documents = log_store(spark, base).read("documents")
    if documents is None:
        return spark.createDataFrame([], schemas.VEGLOG)
    return entries_of(documents if aoi_id is None else documents.where(F.col("aoi_id") == F.lit(aoi_id)))
