"""Incremental load: new segment files change only the entries that they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import delta
from ..operators.tables import written
from ..sources import snapshots


def load_new_segments(spark: SparkSession, folder: str, schema: str, table: str, log: str, checkpoint: str) -> None:
    """Read what arrived, log typed changes and make the new version of the table, one of :mod:`snapshots`; then stop.

    A batch writes the buckets that it touches alone. Its log lies under its number and is made of the table before
    it; the table's new version, which counts all at once, names the batch. So a batch that died on the way is
    repeated as if for the first time, log and table, and one whose version counts is passed over.
    """

    def batch(rows: DataFrame, number: int) -> None:
        now = snapshots.latest(spark, table)
        if now.batches.get(checkpoint, -1) >= number:
            return
        rows = written(rows, "arrived")
        entries = rows.select("entry").distinct()
        buckets = [r["b"] for r in entries.select(snapshots.bucket("entry").alias("b")).distinct().collect()]  # BUCKETS at most
        old = snapshots.read(spark, table, rows.schema, buckets, now)
        snapshots.step("log")
        delta.typed_delta(old.join(entries, "entry", "left_semi"), rows).write.mode("overwrite").parquet(f"{log}/batch={number}")
        kept = old.join(entries, "entry", "left_anti").select(*rows.columns)
        snapshots.replace(spark, table, kept.unionByName(rows), "entry", buckets, batch=(checkpoint, number))

    source = spark.readStream.schema(schema).csv(folder)
    source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
