"""Deliveries as a stream: each micro-batch is merged into the versioned ledger once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.ledger import VersionStore, merge_ledger

#: Buckets of a ledger by key.
BUCKETS = 64


def merge_stream(deliveries: DataFrame, store: VersionStore, name: str, key: list[str], checkpoint: str, day: str = "scan_date", order: str = "row_id") -> StreamingQuery:
    """Merges every delivery of a stream into the ledger `name`, day by day, and publishes a version per day.

    A day older than the newest version comes late: it is merged into that version, where it only adds keys and moves
    first_seen back, so nothing read later lacks it and no last_seen falls. A batch that is run again after a failure
    merges the same rows on the same days, which changes nothing. Runs until all that is there has been read.

    The ledger lies in buckets of its key, and a day's delivery reads and writes only those that hold one of its keys.
    """
    bucket = F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        for (today,) in batch.where(F.col(day).isNotNull()).select(day).distinct().orderBy(day).collect():
            values = [c for c in batch.columns if c not in (day, order, "first_seen", "last_seen")]
            schema = ", ".join(f"`{c}` {batch.schema[c].dataType.simpleString()}" for c in values) + ", first_seen string, last_seen string"
            versions, new = store.versions(), batch.where(F.col(day) == today)
            touched = [r[0] for r in new.select(bucket).distinct().collect()]
            old = store.read(name, buckets=touched) if versions else spark.createDataFrame([], schema)
            merged = merge_ledger(old.select(*values, "first_seen", "last_seen"), new, key, today, [F.col(order)])
            store.publish_buckets(max([today, *versions[-1:]]), name, merged, bucket)

    return deliveries.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
