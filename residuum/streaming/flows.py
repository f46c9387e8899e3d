"""Streams: ingestion that skips what is stored, and windows over event time."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from residuum.operators.store import new_rows
from residuum.sources.inputs import parse_mutation_lines


def ingest_mutations(spark: SparkSession, folder: str, store: str, checkpoint: str) -> StreamingQuery:
    """Append changes of mutation lists that arrive in a folder, each (protein, change) once."""

    def append(batch: DataFrame, _: int) -> None:
        rows = batch.select("protein_id", "change", "kind", "tags")
        try:
            stored = spark.read.parquet(store)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = rows.limit(0)  # nothing is stored yet
        new_rows(stored.select("protein_id", "change"), rows, ["protein_id", "change"]).write.mode("append").parquet(store)

    lines = spark.readStream.text(folder)
    return parse_mutation_lines(lines).writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def with_time(events: DataFrame, column: str = "ts") -> DataFrame:
    """Event time as a timestamp with zone, which watermarks need."""
    return events.withColumn(column, F.col(column).cast("timestamp"))


def tumbling(events: DataFrame, length: str, *keys: str, late: str | None = None) -> DataFrame:
    return _windowed(events, F.window("ts", length), keys, late)


def sliding(events: DataFrame, length: str, step: str, *keys: str, late: str | None = None) -> DataFrame:
    return _windowed(events, F.window("ts", length, step), keys, late)


def sessions(events: DataFrame, gap: str, *keys: str, late: str | None = None) -> DataFrame:
    """Runs of events with less than ``gap`` between them."""
    return _windowed(events, F.session_window("ts", gap), keys, late)


def _windowed(events: DataFrame, window, keys: tuple[str, ...], late: str | None) -> DataFrame:
    """Counts and sums for a window and keys; on a stream, ``late`` says how long to wait."""
    rows = with_time(events)
    if late:
        rows = rows.withWatermark("ts", late)
    found = rows.groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return found.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total")


def latest(events: DataFrame, key: str, late: str) -> DataFrame:
    """Each id once within the time that one waits for late events."""
    return with_time(events).withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def due(notices: DataFrame, late: str) -> DataFrame:
    """Stream of (id, modified_at) that are to be done again: ids that are new, or modified after the last notice.

    The state is one time for each id; notices that repeat, or come late, give nothing. A
    batch's notices of an id give its newest one.
    """

    def newest(key, batches, state):
        import pandas as pd

        last = max(batch["modified_at"].max() for batch in batches)
        if not state.exists or last > pd.Timestamp(state.get[0]):
            state.update((last.to_pydatetime(),))
            yield pd.DataFrame({"id": [key[0]], "modified_at": [last]})

    rows = notices.where("id IS NOT NULL AND modified_at IS NOT NULL").select("id", F.col("modified_at").cast("timestamp").alias("modified_at")).withWatermark("modified_at", late)
    kind = notices.schema["id"].dataType.simpleString()
    return rows.groupBy("id").applyInPandasWithState(newest, f"id {kind}, modified_at timestamp", "modified_at timestamp", "update", GroupStateTimeout.NoTimeout)
