"""The last entries of every area, kept up to date by a stream of log entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupStateTimeout

from verdance.operators.anomalies import advanced_analytics, alert_rows
from verdance.operators.veglog import COLUMNS, ROLLING_ENTRIES, rolling_last
from verdance.streaming.versions import write_next

SLOTS = 64
SLOT_BITS = 16
#: States that the areas of a slot share; each holds a share of the areas, so it stays small.
BUCKETS = 512


def advance(batch: DataFrame, batch_id: int, base: str, k: int = ROLLING_ENTRIES) -> DataFrame:
    """Snapshot of this batch: the newest snapshot and the batch, cut to ``k`` per area.

    The cut is applied before the shuffle, so an area that owns much of the
    batch sends at most ``k`` rows per task.
    """
    entries = batch.select(*COLUMNS)

    def snapshot(before: DataFrame | None) -> DataFrame:
        return rolling_last(entries if before is None else before.unionByName(entries), k)

    return write_next(batch.sparkSession, base, batch_id, snapshot)


def advance_alerts(batch: DataFrame, batch_id: int, base: str) -> DataFrame:
    """Alerts after this batch: anew for its areas, as before for the others."""
    log = advance(batch, batch_id, f"{base}/log")
    changed = batch.select("aoi_id").distinct()
    found = alert_rows(advanced_analytics(log.join(changed, "aoi_id", "left_semi")))

    def alerts(before: DataFrame | None) -> DataFrame:
        return found if before is None else before.join(changed, "aoi_id", "left_anti").unionByName(found)

    return write_next(batch.sparkSession, f"{base}/alerts", batch_id, alerts)


def snapshot_writer(
    entries: DataFrame, base: str, checkpoint: str, k: int = ROLLING_ENTRIES
) -> DataStreamWriter:
    """Stream that keeps the snapshot at ``base``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        advance(batch, batch_id, base, k)

    return entries.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def alert_writer(entries: DataFrame, base: str, checkpoint: str) -> DataStreamWriter:
    """Stream that keeps the snapshot and the alerts that follow from it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        advance_alerts(batch, batch_id, base)
        batch.unpersist()

    return entries.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def entering_entries(
    entries: DataFrame, k: int = ROLLING_ENTRIES, slots: int = SLOTS
) -> DataFrame:
    """Entries that enter the last ``k`` of their area in their slot, from state of ``k`` numbers each.

    Every 2**16 arrivals go to the next slot in turn, so an area that is busy
    is shared by tasks while a quiet one stays in few slots.  An
    entry among the last ``k`` of its area is among the last ``k`` of its slot
    when it arrives, so ``rolling_last`` over the output is exact.

    The areas of a slot share ``BUCKETS`` states, as many areas have few entries
    in a slot and a state apart would cost more than they do.  Areas that are
    missing have a bucket of their own; entries without a number count as oldest.
    """
    columns = list(COLUMNS)

    def keep(key, frames, state):
        import numpy as np
        import pandas as pd

        areas, sizes, last = state.get if state.exists else ([], [], [])
        areas, last = np.array(areas, dtype=object), np.array(last, dtype="int64")
        owner = np.repeat(np.arange(len(areas)), np.array(sizes, dtype="int64"))
        for frame in frames:
            known, seq = len(areas), frame["_seq"].to_numpy()
            codes, areas = pd.factorize(np.concatenate([areas, frame["_area"].to_numpy(dtype=object)]))
            owner, last = np.concatenate([owner, codes[known:]]), np.concatenate([last, seq])
            order = np.lexsort((last, owner))
            owner, last = owner[order], last[order]
            ends = np.searchsorted(owner, np.arange(len(areas)), "right")
            kept = ends[owner] - np.arange(len(owner)) <= k
            owner, last = owner[kept], last[kept]
            oldest = last[np.searchsorted(owner, np.arange(len(areas)))]
            yield frame.loc[seq >= oldest[codes[known:]], columns]
        state.update((areas.tolist(), np.bincount(owner, minlength=len(areas)).tolist(), last.tolist()))

    slot = F.pmod(F.shiftright("seq", SLOT_BITS), F.lit(slots))
    area = F.col("aoi_id")
    return (
        entries.select(*columns)
        .withColumns(
            {
                "_slot": slot,
                "_bucket": F.when(area.isNotNull(), F.pmod(F.xxhash64(area), F.lit(BUCKETS))),
                "_area": F.coalesce(area.cast("string"), F.lit("")),
                "_seq": F.coalesce("seq", F.lit(-(1 << 63))),
            }
        )
        .groupBy("_bucket", "_slot")
        .applyInPandasWithState(
            keep,
            entries.select(*columns).schema,
            "areas array<string>, sizes array<long>, last array<long>",
            "append",
            GroupStateTimeout.NoTimeout,
        )
    )


def state_writer(entries: DataFrame, base: str, checkpoint: str) -> DataStreamWriter:
    return (
        entering_entries(entries)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", base)
        .option("checkpointLocation", checkpoint)
    )
