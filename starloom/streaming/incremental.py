"""Continuous incremental load: files that land are upserted as they come."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from starloom.plans.run import ARRIVAL
from starloom.sinks.store import StarStore


def read_landing(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", **options: str) -> DataFrame:
    """New files of a landing folder as a stream."""
    return spark.readStream.format(format).schema(schema).options(**options).load(path)


def stream_upsert(
    stream: DataFrame,
    store: StarStore,
    table: str,
    key: Sequence[str],
    order_by: Sequence[str],
    checkpoint: str,
    *,
    once: bool = True,
    interval: str = "1 minute",
    compact_every: int = 20,
) -> StreamingQuery:
    """Upsert each batch by key, exactly once.

    The checkpoint remembers which files were read, and the table, with its rows, which batch
    of this checkpoint it has taken in. So a batch that is run again after a failure is either
    skipped or replaces what had not been committed. Rows that ``order_by`` does not tell apart:
    the one that arrives last stays. If the table has buckets of the key, a batch rewrites only
    those it touches. After every ``compact_every`` batches folders of appended rows are put
    together and what only earlier versions need is removed.
    """
    if not key:
        raise ValueError("a continuous load needs a key")

    def load(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn(ARRIVAL, F.monotonically_increasing_id())
        store.upsert(table, rows, key, [*order_by, ARRIVAL], batch=(checkpoint, number))
        if compact_every and number % compact_every == compact_every - 1:
            if store.version(table).in_folders:
                store.compact(table)
            store.drop_old_versions(table)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()
