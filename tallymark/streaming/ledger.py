"""One stream into several sinks, each batch once in all of them or in none."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallymark.streaming.ndjson import CORRUPT

Sinks = Mapping[str, Callable[[DataFrame], DataFrame]]

#: Rows that parsed, lines that did not, and how many there are of both.
GOOD_AND_BAD: Sinks = {
    "good": lambda batch: batch.filter(F.col(CORRUPT).isNull()).drop(CORRUPT),
    "bad": lambda batch: batch.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value")),
    "counts": lambda batch: batch.agg(
        F.count_if(F.col(CORRUPT).isNull()).alias("good"), F.count_if(F.col(CORRUPT).isNotNull()).alias("bad")
    ),
}
_LEDGER = "ledger"


def ingest_to_sinks(
    parsed: DataFrame, out: str, checkpoint: str, sinks: Sinks = GOOD_AND_BAD, once: bool = True
) -> StreamingQuery:
    """Write what each sink takes of every batch of a stream to `out/<sink>`, as parquet.

    A batch has a folder of its own in each sink, and the ledger an entry for it, written last. A
    batch that is handled again after a crash, which the checkpoint asks for with the same rows
    and number, replaces its folders; `read_sink` shows a batch only once the ledger has it. So every sink has
    each row once, and the sinks never differ in the batches they show. One stream per `out`.
    """
    if _LEDGER in sinks:
        raise ValueError(f"a sink cannot be called {_LEDGER}")
    session = parsed.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        for name, take in sinks.items():
            take(batch).write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
        entry = batch.sparkSession.range(1).select(F.current_timestamp().alias("written"))
        entry.coalesce(1).write.mode("overwrite").parquet(f"{out}/{_LEDGER}/batch={number}")

    # So that the sinks can be read before there is a batch: batch -1 has no rows.
    nothing = session.createDataFrame([], parsed.schema)
    for name, take in sinks.items():
        take(nothing).limit(0).write.mode("ignore").parquet(f"{out}/{name}/batch=-1")
    empty = session.range(0).select(F.current_timestamp().alias("written"))
    empty.write.mode("ignore").parquet(f"{out}/{_LEDGER}/batch=-1")
    writer = parsed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_sink(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The rows of a sink, with their batch, of all batches that are whole."""
    whole = spark.read.parquet(f"{out}/{_LEDGER}").select("batch").distinct()
    return spark.read.parquet(f"{out}/{name}").join(whole, "batch", "left_semi")
