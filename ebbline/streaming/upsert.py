"""Upserts from a stream: a change log by batch, merged on read and folded in now and then."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ebbline.fixed_values import KEY
from ebbline.operators.keyed import last_per_key, upsert


def stream_changes(records: DataFrame, order: str, log: str, checkpoint: str, key: str = KEY) -> StreamingQuery:
    """Write each micro-batch's last record per key to the change log.

    `order` is a time or sequence number that the records carry. The cost of a batch depends on the batch, not on
    the table. Every start of the stream writes to a folder of its own, so batch numbers that begin again
    after a lost checkpoint overwrite nothing; a batch that is replayed adds equal records, which change nothing.
    """
    run = uuid.uuid4().hex

    def write(batch: DataFrame, batch_id: int) -> None:
        usable = batch.where(F.col(key).isNotNull())
        folder = f"{log}/run_id={run}/batch_id={batch_id}"
        last_per_key(usable, key, [F.col(order)]).write.mode("overwrite").parquet(folder)

    return (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merged(
    table: DataFrame, log: DataFrame, order: str, key: str = KEY, defaults: dict[str, Column] | None = None
) -> DataFrame:
    """The table with the newest logged record of every key applied; writing it out folds the log in.

    Newest by the records' own order; batch and run only part records that are equal in it.
    """
    newest = last_per_key(log, key, [F.col(order), F.col("batch_id"), F.col("run_id")]).drop("batch_id", "run_id", order)
    return upsert(table, newest, key, defaults)
