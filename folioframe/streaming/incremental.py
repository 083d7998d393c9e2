"""Each input handled once, by file-source checkpoints and by keys already in the sink."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.operators.pairing import pending
from folioframe.session import cut, discard
from folioframe.streaming.key_index import files_with, index_files, key_bucket


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at a path, empty when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


#: Rows of one file, so that a task that makes its key filter holds no more hashes.
FILE_ROWS = 1 << 22


def unseen(rows: DataFrame, path: str, key: str | Sequence[str]) -> DataFrame:
    """The rows whose key the table does not hold; only files that may hold one are read."""
    keys = [key] if isinstance(key, str) else list(key)
    spark = rows.sparkSession
    files = files_with(rows.select(*keys), path, keys)
    if not files:
        return rows
    return pending(rows, spark.read.schema(rows.select(*keys).schema).parquet(*map(unquote, files)), keys)


def append_unseen(batch: DataFrame, path: str, key: str | Sequence[str]) -> None:
    """Append rows whose key the table does not hold; a repeated batch adds nothing.

    What was seen is the table itself, so no streaming state grows with the corpus; of it only the
    files are read whose key filters (``key_index``) pass a key of the batch. Of several
    rows of a key the one of the smallest content hash stays, the same on every run. Rows with a
    null or empty key can't be told apart later and are left out. A batch's rows are dealt to files
    by key bucket, so a file has filters for few buckets.
    """
    keys = [key] if isinstance(key, str) else list(key)
    named = batch
    for name in keys:
        named = named.where(F.col(name).isNotNull() & (F.col(name).cast("string") != ""))
    rest = [c for c in batch.columns if c not in keys]
    picked = F.min_by(F.struct(*rest), F.xxhash64(*batch.columns)).alias("_row") if rest else None
    one = named.groupBy(*keys).agg(picked) if rest else named.distinct()
    rows = one.select(*keys, "_row.*").select(batch.columns) if rest else one
    # the batch is asked for its keys first and written then: it is made once
    rows, row_path = cut(rows, "batch")
    fresh = unseen(rows, path, keys).repartition(key_bucket(keys))
    fresh.write.mode("append").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    index_files(batch.sparkSession, path, rows.select(*keys).schema, keys)
    discard(batch.sparkSession, row_path)


def run_available(
    source: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]
) -> None:
    """Process all files not handled by an earlier run with this checkpoint, then stop."""
    query = (
        source.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(handle).start()
    )
    query.awaitTermination()


def stream_append(source: DataFrame, path: str, checkpoint: str, key: str | Sequence[str]) -> None:
    """Incremental append of new keys from a stream."""
    run_available(source, checkpoint, lambda batch, _: append_unseen(batch, path, key))


def convert_incrementally(
    source: DataFrame, convert: Callable[[DataFrame], DataFrame], key: str, output: str,
    quarantine: str, checkpoint: str, failed: str = "error",
) -> None:
    """Convert new files once. ``convert`` adds a ``failed`` column (NULL = fine).

    Failed inputs go to the quarantine table. Every run also retries what is in there and
    still has no output, so a failure neither stops the run nor loses its input.
    """
    spark = source.sparkSession
    inputs = source.columns

    def store(result: DataFrame) -> None:
        kept, path = cut(result, "converted")
        append_unseen(kept.filter(F.col(failed).isNull()).drop(failed), output, key)
        append_unseen(kept.filter(F.col(failed).isNotNull()).select(*inputs), quarantine, key)
        discard(spark, path)

    waiting = read_table(spark, quarantine, source.schema)
    store(convert(unseen(waiting, output, key)))
    run_available(source, checkpoint, lambda batch, _: store(convert(batch)))


def unresolved(spark: SparkSession, quarantine: str, output: str, schema, key: str) -> DataFrame:
    """Quarantined inputs that no run has converted yet."""
    return unseen(read_table(spark, quarantine, schema), output, key)
