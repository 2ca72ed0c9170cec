"""A1, A3: load the reference's three-file CSV layout as one DataFrame.

``x_train.csv`` / ``x_test.csv``: header, id first, numeric features (empty or
junk cells are missing). ``y_train.csv``: header, id, label in {-1, 1}.

Every column is read as text and converted with ``try_cast`` so a junk cell
becomes NULL instead of failing the job (ANSI mode is on in Spark 4). Labels
are joined to features on the id (the reference aligns them by row position). A training row
without a label, or an id with two labels, fails the load; ``unmatched_ids`` lists
the ids present on one side only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators.split import stride_sample


def _header(spark: SparkSession, path: str) -> list[str]:
    # the header row only: the first line of the first file
    return spark.read.option("header", True).csv(path).columns


def read_feature_csv(spark: SparkSession, path: str, split: str) -> DataFrame:
    cols = _header(spark, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    raw = spark.read.option("header", True).schema(schema).csv(path)
    id_col = cols[0]
    feats = [F.nanvl(F.col(c).try_cast("double"), F.lit(None).cast("double")).alias(c) for c in cols[1:]]
    return raw.select(F.col(id_col).try_cast("bigint").alias("id"), F.lit(split).alias("split"), *feats)


def read_labels_csv(spark: SparkSession, path: str) -> DataFrame:
    cols = _header(spark, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    raw = spark.read.option("header", True).schema(schema).csv(path)
    return raw.select(F.col(cols[0]).try_cast("bigint").alias("id"), F.col(cols[1]).try_cast("int").alias("label"))


def load_csv_data(spark: SparkSession, data_path: str, sub_sample: bool = False,
                  on_unlabelled: str = "error") -> DataFrame:
    """(id, split, label, features...) for train and test rows; test rows have
    a NULL label. ``sub_sample`` keeps a deterministic 1-in-50 of training rows.

    Training rows without a label raise when they are read, or keep a NULL label with
    ``on_unlabelled="keep"``. An id with several labels always raises."""
    if on_unlabelled not in ("error", "keep"):
        raise ValueError("on_unlabelled must be 'error' or 'keep'")
    base = data_path.rstrip("/")
    x_tr = read_feature_csv(spark, f"{base}/x_train.csv", "train")
    x_te = read_feature_csv(spark, f"{base}/x_test.csv", "test")
    y = read_labels_csv(spark, f"{base}/y_train.csv")
    one = y.groupBy("id").agg(F.max("label").alias("__label"), F.count("*").alias("__labels"))
    train = x_tr.join(one, "id", "left")
    label = F.when(F.col("__labels") > 1, F.raise_error(F.concat(F.lit("several labels for id "), F.col("id").cast("string"))))
    if on_unlabelled == "error":
        label = label.when(F.col("__label").isNull(),
                           F.raise_error(F.concat(F.lit("no label for id "), F.coalesce(F.col("id").cast("string"), F.lit("null")))))
    train = train.withColumn("label", label.otherwise(F.col("__label")).cast("int"))
    if sub_sample:
        train = stride_sample(train, 50, "sample", "id")
    feats = [c for c in x_tr.columns if c not in ("id", "split")]
    test = x_te.withColumn("label", F.lit(None).cast("int"))
    return train.select("id", "split", "label", *feats).unionByName(test.select("id", "split", "label", *feats))


def unmatched_ids(spark: SparkSession, data_path: str) -> DataFrame:
    """Ids with features but no label, or a label but no features."""
    base = data_path.rstrip("/")
    x_tr = read_feature_csv(spark, f"{base}/x_train.csv", "train").select("id")
    y = read_labels_csv(spark, f"{base}/y_train.csv").select("id")
    return (x_tr.join(y, "id", "left_anti").withColumn("missing", F.lit("label"))
            .unionByName(y.join(x_tr, "id", "left_anti").withColumn("missing", F.lit("features"))))
