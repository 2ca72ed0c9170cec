"""G5 on a stream: a fitted model is literals only, so its scoring projection
runs unchanged on a ``readStream`` frame (no state, no shuffle). Offsets and the sink's list of
files live in a checkpoint folder, so a query that was stopped in the middle goes on
behind the last finished micro-batch and no row is scored into the sink twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskspark.operators.clean import CleaningModel
from riskspark.plans.models import LinearScorer


def score_stream(stream: DataFrame, cleaning: CleaningModel, scorer: LinearScorer) -> DataFrame:
    """Clean + score every arriving row: (id, score, prediction)."""
    clean = cleaning.transform(stream)
    return scorer.transform(clean).select("id", "score", "prediction")


def parquet_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def score_available(stream: DataFrame, cleaning: CleaningModel, scorer: LinearScorer, out: str, checkpoint: str,
                    timeout: float | None = None) -> None:
    """Score what the source holds now into Parquet files at ``out``, micro-batch by micro-batch, and end.

    Called again with the same folders it goes on with what has come since, or with what a call that
    was stopped has left. Read ``out`` with Spark, which reads finished micro-batches only."""
    query = (score_stream(stream, cleaning, scorer).writeStream.format("parquet").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).outputMode("append").start(out))
    query.awaitTermination(timeout)
    if query.isActive:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
