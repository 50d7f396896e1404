"""Streams: triage of arriving messages and an incremental author audit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from caseweave.functions.text import safe_ratio


def start_triage(
    messages: DataFrame, triage_batch: Callable[[DataFrame], DataFrame], target: str, checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Triage a message stream batch by batch and write each batch to its own folder below ``target``.

    Ranking is not possible on a stream itself, so each batch is an ordinary table. A batch that is repeated after
    a failure overwrites its own folder, so the target holds every message once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        triage_batch(batch).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


ID_BUCKETS = 64


def start_audit(
    events: DataFrame, target: str, checkpoint: str, author: str = "user_id", event_id: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Write each batch's counts per author below ``target``; :func:`author_activity` adds them up.

    Every event counts, whatever its time. With ``event_id`` an event counts once, however late a copy comes: the ids
    of each batch are kept below ``target`` in buckets, and a batch drops the ids that an earlier batch has written. A
    null id is no copy of another. A batch that is repeated after a failure looks at earlier batches only and
    overwrites its own folders, so it gives the same counts again.
    """
    spark = events.sparkSession
    counts_at, ids_at = f"{target}/counts", f"{target}/ids"
    _counted(spark.createDataFrame([], events.schema), author).write.mode("ignore").parquet(f"{counts_at}/batch=-1")
    if event_id:
        ids = spark.createDataFrame([], events.schema).select(event_id)
        ids.write.mode("ignore").parquet(f"{ids_at}/batch=-1/bucket=0")

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if event_id:
            bucket = F.pmod(F.xxhash64(event_id), F.lit(ID_BUCKETS)).cast("int")
            named = batch.where(F.col(event_id).isNotNull()).dropDuplicates([event_id]).withColumn("bucket", bucket)
            schema = named.select(event_id).schema.add("batch", "long").add("bucket", "integer")
            seen = session.read.schema(schema).parquet(ids_at).where(F.col("batch") < batch_id)
            fresh = named.join(seen.select(event_id, "bucket"), [event_id, "bucket"], "left_anti")
            own = f"{ids_at}/batch={batch_id}"
            fresh.select(event_id, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(own)
            batch = fresh.select(*batch.columns).unionByName(batch.where(F.col(event_id).isNull()))
        _counted(batch, author).write.mode("overwrite").parquet(f"{counts_at}/batch={batch_id}")

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _counted(events: DataFrame, author: str) -> DataFrame:
    return events.where(F.col(author).isNotNull()).groupBy(author).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.sum(F.col("value").cast("double")).alias("total_value"),
    )


def author_activity(spark: SparkSession, target: str, author: str = "user_id") -> DataFrame:
    """The current audit: the sums of all batches' counts."""
    summed = spark.read.parquet(f"{target}/counts").groupBy(author).agg(
        *[F.sum(c).alias(c) for c in ("events", "errors", "total_value")]
    )
    return summed.withColumn("error_rate", safe_ratio(F.col("errors"), F.col("events")))
