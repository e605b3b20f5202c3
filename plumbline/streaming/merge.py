"""Versioned merge as a file stream: late rows win or lose by version, never by arrival."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plumbline.operators.versions import latest_by


def read_events(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """A folder of event files as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def start_merge(events: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[str]) -> StreamingQuery:
    """Write each micro-batch's newest row per key to a folder of its own.

    No watermark: it would drop exactly the late rows that must still be able to
    win. A batch that runs again overwrites its own folder with the same rows, so
    the sink stays right when a driver or executor is lost between write and
    commit. The merged state is never rewritten; ``merged`` computes it.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        latest_by(batch, keys, order).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return (
        events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def merged(spark: SparkSession, target: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Greatest version per key over everything the stream has written."""
    written = spark.read.schema(schema).parquet(target)
    return latest_by(written.select(*[f.name for f in schema]), keys, order)


def compact(spark: SparkSession, target: str, compacted: str, schema: T.StructType, keys, order) -> None:
    """Write the merged state as one batch folder, for readers of long-running streams."""
    merged(spark, target, schema, keys, order).write.mode("overwrite").parquet(f"{compacted}/batch_id=-1")


def late_rows(batch: DataFrame, state: DataFrame, at: str) -> DataFrame:
    """Rows older than the newest instant already merged."""
    newest = state.agg(F.max(at)).scalar()
    return batch.where(F.col(at) < newest)
