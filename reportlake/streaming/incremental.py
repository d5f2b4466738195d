"""Landed rows as a stream: every micro-batch rebuilds the keys that it brings, so a replayed batch changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reportlake.files import files_at
from reportlake.operators.store import Destination


def rebuild_from_stream(rows: DataFrame, table: Destination, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Rebuilds ``table`` from a stream of destination rows; the batch's own keys are its coverage.

    A key's rows must land together (one file per pull), as an extract's answer for a day does.
    """

    def step(batch: DataFrame, _: int) -> None:
        held = batch.persist()
        try:
            table.rebuild(held.select(*table.keys).distinct(), held)
        finally:
            held.unpersist()

    writer = rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def late_counts(events: DataFrame, time: str, key: str, window: str, lateness: str) -> DataFrame:
    """Counts per key and tumbling window of an event stream; rows later than ``lateness`` are left out."""
    timed = events.withWatermark(time, lateness)
    out = timed.groupBy(F.window(time, window).alias("w"), key).agg(F.count("*").alias("n"))
    return out.select("w.start", "w.end", key, "n")


def landed(spark: SparkSession, path: str, schema: object) -> DataFrame:
    """A stream of the Parquet files that land in a folder."""
    return spark.readStream.schema(schema).parquet(path)


def forget_last_commit(spark: SparkSession, checkpoint: str) -> bool:
    """Takes back that the last batch of a stopped stream was done, so that it runs again; False if there is none."""
    files = files_at(spark, f"{checkpoint}/commits")
    done = sorted((n for n in files.names("") if n.isdigit()), key=int)
    for n in done[-1:]:
        files.delete(n)
        files.delete(f".{n}.crc")
    return bool(done)
