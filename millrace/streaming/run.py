"""Running a stream over the input present and reading back what it wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.session import scratch_path, settings

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_settings(spark: SparkSession, partitions: int | None = None) -> dict[str, str]:
    """State on local disk with a changelog in the checkpoint, one partition per core.

    A restarted query keeps the number of partitions its checkpoint was made with.
    """
    return {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism),
        # Rows of one session are merged in the task that read them, before the shuffle.
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }


def _finish(spark: SparkSession, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    # A query copies the session settings when it starts.
    with settings(spark, state_settings(spark)):
        query = start()
    query.awaitTermination()
    return query


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process the input present now and append the result to Parquet files."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return _finish(stream.sparkSession, lambda: writer.start(path))


def each_batch(
    stream: DataFrame, mode: str, write: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process the input present now and hand every micro-batch to ``write``."""
    writer = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return _finish(stream.sparkSession, writer.start)


def append_and_read(stream: DataFrame, label: str) -> DataFrame:
    """``append_to`` a new folder, then the result as a batch DataFrame."""
    spark = stream.sparkSession
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    append_to(stream, out, checkpoint)
    return spark.read.schema(stream.schema).parquet(out)


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def replace_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch under its own folder, so a replayed one replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return write


def multi_sink(sinks: dict[str, Callable[[DataFrame], DataFrame]], root: str):
    """One pass over a micro-batch for several outputs, each replaced on replay."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, select in sinks.items():
                select(batch).write.mode("overwrite").parquet(
                    batch_folder(f"{root}/{name}", batch_id)
                )
        finally:
            batch.unpersist()

    return write
