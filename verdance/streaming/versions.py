"""Result tables that grow by one version per micro-batch.

Data lie in ``v=<number>``, and a version counts once its mark in ``_commits``
is there.  A mark is an empty folder whose name holds the version, whether the
version holds all rows, and the streaming query with its batch: a replayed batch
replaces its own version, and a query with a new checkpoint goes on from the
newest version of the old one.  Marks are listed by name, which starts no job.

Versions that nothing needs any more are removed: of snapshots all but the
newest two, of changed rows those before the last merged version.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.plans.ordering import first_rows

#: Versions of changed rows after which they are merged into one.
MERGE_EVERY = 16


@dataclass(frozen=True, order=True)
class Commit:
    v: int
    whole: bool
    run: str
    batch: int

    @property
    def name(self) -> str:
        return f"{self.v:012d}_{int(self.whole)}_{self.run}_{self.batch}"


def running_query(spark: SparkSession) -> str:
    """The id of the streaming query whose batch is being written; it is kept in its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def folder_of(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def commits(spark: SparkSession, base: str) -> list[Commit]:
    """The committed versions that are kept, in order."""
    files, place = folder_of(spark, f"{base}/_commits")
    if not files.exists(place):
        return []
    names = [status.getPath().getName().split("_") for status in files.listStatus(place)]
    return sorted(Commit(int(v), whole == "1", run, int(batch)) for v, whole, run, batch in names)


def _commit(spark: SparkSession, base: str, commit: Commit) -> None:
    files, place = folder_of(spark, f"{base}/_commits/{commit.name}")
    files.mkdirs(place)


def _remove(spark: SparkSession, base: str, old: Sequence[Commit]) -> None:
    for commit in old:
        for path in (f"{base}/_commits/{commit.name}", f"{base}/v={commit.v}"):
            files, place = folder_of(spark, path)
            files.delete(place, True)


def write_next(
    spark: SparkSession,
    base: str,
    batch_id: int,
    make: Callable[[DataFrame | None], DataFrame],
    whole: bool = True,
    keep: int | None = 2,
) -> DataFrame:
    """Writes the version that ``make`` forms from the newest one before it.

    Of whole versions the newest ``keep`` stay, by default this one and the one
    that a replay of it starts from.
    """
    run, done = running_query(spark), commits(spark, base)
    own = [c for c in done if (c.run, c.batch) == (run, batch_id)]
    number = own[0].v if own else max([c.v for c in done], default=-1) + 1
    earlier = [c for c in done if c.v < number]
    made = make(read_version(spark, base, earlier[-1].v) if earlier else None)
    made.write.mode("overwrite").parquet(f"{base}/v={number}")
    if not own:
        _commit(spark, base, Commit(number, whole, run, batch_id))
    if whole and keep:
        _remove(spark, base, earlier[: len(earlier) + 1 - keep])
    return read_version(spark, base, number)


def write_version(df: DataFrame, base: str, batch_id: int, keys: Sequence[str] = ()) -> None:
    """Writes the changed rows of a batch; with ``keys``, versions are merged from time to time.

    Rows of a later version replace those with equal keys.
    """
    spark = df.sparkSession
    run, done = running_query(spark), commits(spark, base)
    own = [c for c in done if (c.run, c.batch) == (run, batch_id)]
    behind = next((i for i, c in enumerate(reversed(done)) if c.whole), len(done))
    # A replay of a merging batch merges again, as its version stands for all before it.
    if not (keys and (own[0].whole if own else behind >= MERGE_EVERY)):
        write_next(spark, base, batch_id, lambda _: df, whole=False)
        return

    def merged(_: DataFrame | None) -> DataFrame:
        before = [c for c in done if c not in own]
        rows = _rows(spark, base, before).unionByName(df.withColumn("v", F.lit(1 << 60).cast("long")))
        return first_rows(rows, keys, [F.col("v").desc()], 1).drop("v")

    write_next(spark, base, batch_id, merged, whole=True, keep=None)
    done = commits(spark, base)
    whole = [c.v for c in done if c.whole]
    # A replay of the merging batch needs what it merged, so that goes with the next merge.
    if len(whole) > 1:
        _remove(spark, base, [c for c in done if c.v < whole[-2]])


def read_version(spark: SparkSession, base: str, number: int) -> DataFrame:
    return spark.read.parquet(f"{base}/v={number}")


def latest_version(spark: SparkSession, base: str) -> DataFrame:
    """The whole of the newest committed version, be it empty."""
    done = commits(spark, base)
    if not done:
        raise LookupError(f"no version in {base}")
    return read_version(spark, base, done[-1].v)


def _rows(spark: SparkSession, base: str, done: Sequence[Commit]) -> DataFrame:
    """Rows of the versions from the last whole one on, with their version ``v``."""
    first = max([c.v for c in done if c.whole], default=0)
    paths = [f"{base}/v={c.v}" for c in done if c.v >= first]
    return spark.read.option("basePath", base).parquet(*paths).withColumn("v", F.col("v").cast("long"))


def latest_rows(spark: SparkSession, base: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key over the committed versions (versions hold changed keys only)."""
    rows = _rows(spark, base, commits(spark, base))
    return first_rows(rows, keys, [F.col("v").desc()], 1).drop("v")


def run_available(writer) -> None:
    """Process what the source holds now, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
