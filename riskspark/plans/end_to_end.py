"""The reference's end-to-end run as Spark jobs.

clean by spec -> intercept -> 80/20 holdout -> 5-fold CV (logistic GD,
threshold search) -> fold averaging -> holdout metrics -> test predictions
-> CSV submission in the shared output folder."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators import evaluate
from riskspark.operators.clean import CleaningEstimator
from riskspark.plans import cv
from riskspark.plans.models import LinearScorer
from riskspark.session import scratch_path
from riskspark.sources.csv_source import load_csv_data
from riskspark.sources.sink import write_submission
from riskspark.sources.spec import FeatureSpec, read_spec
from riskspark.sources.tables import order_risk
from riskspark.specs import spec_path


@dataclass
class RunResult:
    cv: cv.CVResult
    scorer: LinearScorer
    holdout: dict
    predictions: DataFrame


def run_table(spark: SparkSession, df: DataFrame, specs: list[FeatureSpec], steps: int = 400, gamma: float = 0.7,
              search: int = 100, k: int = 5, seed: int = 1, write_to: str | None = None) -> RunResult:
    """The run over any (id, split, label, features) table. Predictions are always written (to a
    fresh folder of the shared scratch area unless ``write_to`` names one) and read back."""
    model = CleaningEstimator(specs).fit(df)
    layout = model.layout.with_intercept()
    clean = model.transform(df)
    data = cv.prepare(clean, layout, k, seed)
    res = cv.cross_validate(data, layout, [cv.ModelConfig("logistic", steps, gamma)], k,
                            search_thresholds=search)
    w, thr, mu, sd = res.average(0)
    scorer = LinearScorer(layout, w, mu, sd, logistic=True, threshold=thr)
    hold = scorer.transform(data.filter(F.col("holdout")).withColumn("label", F.col("y").cast("int")))
    metrics = evaluate.confusion_metrics(hold, "label", "prediction").first().asDict()
    preds = (scorer.transform(clean.filter(F.col("split") == "test"))
             .select(F.col("id").alias("Id"), F.col("prediction").alias("Prediction")))
    path = write_submission(preds, write_to or scratch_path(spark, f"submissions-{uuid.uuid4().hex}"))
    written = spark.read.option("header", True).schema("Id BIGINT, Prediction INT").csv(path)
    return RunResult(res, scorer, metrics, written)


def run(spark: SparkSession, sf_dir: str, **settings) -> RunResult:
    """The run over the orders table with its packaged spec."""
    return run_table(spark, order_risk(spark, sf_dir), read_spec(spark, spec_path("order_risk")), **settings)


def run_files(spark: SparkSession, data_path: str, metadata_path: str, sub_sample: bool = False, **settings) -> RunResult:
    """The run from files: x_train.csv, y_train.csv and x_test.csv under ``data_path`` and a JSON feature
    spec. The three files are cleaned, cross-validated, and the test rows' predictions written as CSV."""
    return run_table(spark, load_csv_data(spark, data_path, sub_sample), read_spec(spark, metadata_path), **settings)
