"""Watching the control table for categories that have been loaded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from basketshift.session import staging_path


def watch(spark: SparkSession, control: str, handle: Callable[[DataFrame], object], every: str | None = "1 hour",
          checkpoint: str | None = None, file_format: str = "parquet") -> StreamingQuery:
    """Calls ``handle`` with the pending rows that arrived since the last trigger.

    With ``every=None`` it handles what is there and stops. Rows that a batch marks done
    arrive as well and are passed over.
    """
    stream = spark.readStream.schema("status string, dt string, cid3 string").format(file_format).load(control)

    def on_batch(rows: DataFrame, _: int) -> None:
        pending = rows.where("status = '0'")
        if not pending.isEmpty():
            handle(pending)

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint or staging_path(spark, "watch"))
            .trigger(**trigger).start())
