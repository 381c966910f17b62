"""A watched folder as a stream: every new file is taken in once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import digests, exists, replace_newer, take_in


def process_inbox(spark: SparkSession, inbox: str, schema: str, take: Callable[[DataFrame, int], None], checkpoint: str, kind: str = "parquet") -> None:
    """Take in all files that are new since the last call, in micro-batches, and stop. The checkpoint remembers what was
    taken; `take` may see a batch again after a failure, so it has to replace rather than append."""
    stream = spark.readStream.schema(schema).format(kind).load(inbox)
    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def upsert_inbox(spark: SparkSession, inbox: str, parse: Callable[[DataFrame], DataFrame], table: str, manifest: str, checkpoint: str, key: str, revision: Sequence[str], partition: str, files_at_once: int = 1000, lines: bool = False) -> DataFrame:
    """Take in new files of any kind and bring their rows into a table, each row once: files whose content was taken in before
    are passed over, and of each key the latest revision stays, however late others arrive.

    Both writes of a batch can be done again: its part of the manifest goes by the batch's number, and the table is replaced
    by key. So a batch that fails anywhere between them, and comes again, leaves one copy. parse: files (file_name, content) to
    rows with `key`, `revision` and `partition`.

    A task holds the whole content of a file, of 2 GB at most. With `lines` files may be of any length: they are read in splits,
    parse gets their lines (file_name, line), and those with the same lines have the same content, in whatever order these stand.
    """

    def take(batch: DataFrame, number: int) -> None:
        received = digests(batch) if lines else batch
        fresh = F.broadcast(take_in(spark, manifest, received, ["file_name"], number).where("status = 'new'").select("file_name"))  # files_at_once names
        replace_newer(spark, table, parse(batch.join(fresh, "file_name", "left_semi")), key, revision, partition)

    if lines:
        stream = spark.readStream.option("maxFilesPerTrigger", files_at_once).text(inbox).select(F.col("_metadata.file_path").alias("file_name"), F.col("value").alias("line"))
    else:
        whole = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", files_at_once).load(inbox)
        stream = whole.select(F.col("path").alias("file_name"), "content")
    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(table) if exists(spark, table) else None
