"""Deliveries that keep coming: a folder of snapshot files followed as a stream.

The batch operators are the state: each micro-batch is reconciled with what the last one
left in a table, so a restarted stream continues from its checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from glossweave.session import shared_dir


def follow(spark: SparkSession, folder: str, schema, each: Callable[[DataFrame, int], None], name: str, files_per_batch: int = 1, once: bool = False, progress: str | None = None) -> StreamingQuery:
    """Calls ``each(rows, batch number)`` for every delivery that lands in ``folder``; ``once`` stops when it is drained.

    How far it came is kept in ``progress``, by default a folder of the stream's name in the shared one.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    writer = rows.writeStream.foreachBatch(each).option("checkpointLocation", progress or f"{shared_dir(spark)}/{name}")
    return (writer.trigger(availableNow=True) if once else writer).start()


def latest_records(rows: DataFrame, keys: list[str], version: str, delay: str) -> DataFrame:
    """A stream of record versions without the repeated ones: a (key, version) that comes again within ``delay`` is dropped."""
    return rows.withWatermark(version, delay).dropDuplicatesWithinWatermark([*keys, version])


def changes_per_window(rows: DataFrame, at: str, by: list[str], width: str, delay: str) -> DataFrame:
    """Counts of a change stream per time window and group; a window is final ``delay`` after its end."""
    return rows.withWatermark(at, delay).groupBy(F.window(at, width), *by).agg(F.count(F.lit(1)).alias("n_changes"))
