"""The ingest queue as a micro-batch stream of Parquet files; message bodies are JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelane.operators.messages import dead_letters, validate

FILES_A_BATCH = 10
TRIES = 3


def read_queue(spark: SparkSession, path: str, schema: str, files: int = FILES_A_BATCH) -> DataFrame:
    """The files of a queue's folder and of folders in it, as a stream."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true")
    return reader.parquet(path)


def process_queue(messages: DataFrame, out: str, checkpoint: str, failed: Column | None = None, body: str = "body", again: str | None = None, tries: int = TRIES, bounded: bool = False):
    """Validates each batch and appends it by outcome; ends when what is there is processed.

    ``bounded`` is for sources that give out a batch at a time (see ``read_messages``), which end when nothing is left.

    A batch that is run again overwrites its own folder, so every message is written once. With ``again``, the folder of
    the queue, messages (which then have a column attempt, from 0) with outcome ``retry`` come back as new files for the
    next run; after so many tries the outcome is ``dead``.
    """
    failed = F.lit(False) if failed is None else failed
    columns = messages.columns

    def batch(df: DataFrame, number: int) -> None:
        done = dead_letters(validate(df, body), failed)
        if again:
            last = (F.col("outcome") == "retry") & (F.col("attempt") + 1 >= tries)
            done = done.withColumn("outcome", F.when(last, "dead").otherwise(F.col("outcome")))
        done.write.mode("overwrite").partitionBy("outcome").parquet(f"{out}/batch={number}")
        if again:
            back = done.where("outcome = 'retry'").withColumn("attempt", (F.col("attempt") + 1).cast(df.schema["attempt"].dataType))
            back.select(*columns).write.mode("overwrite").parquet(f"{again}/retry-{number}")

    writer = messages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if bounded:
        query = writer.start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    else:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
    return query
