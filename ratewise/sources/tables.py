"""Parquet tables and text sinks of the workflows."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.schema import FEATURES, PREDICTIONS, REVIEW
from ratewise.sources.reviews import load_test, load_train


_MANIFEST = "manifest.json"


def _store(spark: SparkSession, path: str):
    """(file system, maker of its paths) of a folder."""
    context = spark.sparkContext
    make = context._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(context._jsc.hadoopConfiguration()), make


def dataset_manifest(spark: SparkSession, path: str) -> dict | None:
    """What the dataset at ``path`` consists of; None if there is none, or if its writing was cut off."""
    store, make = _store(spark, path)
    if not store.exists(make(f"{path}/{_MANIFEST}")):
        return None
    return json.loads(spark.read.text(f"{path}/{_MANIFEST}", wholetext=True).first()[0])


def _publish(spark: SparkSession, path: str, manifest: dict) -> None:
    """Put a manifest in place by one rename."""
    store, make = _store(spark, path)
    draft, final = (store.makeQualified(make(f"{path}/{name}")) for name in (f".{manifest['version']}.json", _MANIFEST))
    out = store.create(draft)
    out.write(bytearray(json.dumps(manifest).encode("utf-8")))
    out.close()
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, final, options)


def write_dataset(reviews: DataFrame, path: str) -> None:
    """Write one version of a dataset, partitioned by ``split``, and make it the current one.

    A version is a folder of its own. Readers find it through a manifest, which
    is put in place after all rows are written; until then they see the version
    before, or none. Versions before are removed last.
    """
    spark, version = reviews.sparkSession, f"version-{uuid.uuid4().hex}"
    folder = f"{path}/{version}"
    reviews.select(*REVIEW.fieldNames()).write.partitionBy("split").parquet(folder)
    counts = {r.split: r["count"] for r in spark.read.schema(REVIEW).parquet(folder).groupBy("split").count().collect()}
    _publish(spark, path, {"version": version, "rows": counts, "fields": REVIEW.fieldNames()})
    store, make = _store(spark, path)
    for found in store.listStatus(make(path)):
        name = found.getPath().getName()
        if name.startswith("version-") and name != version:
            store.delete(found.getPath(), True)


def create_dataset(
    spark: SparkSession, train_folder: str, test_folder: str, path: str, overwrite_old: bool = True
) -> None:
    """Parse both folders once into one dataset; a complete one is kept unless ``overwrite_old``."""
    if not overwrite_old and dataset_manifest(spark, path) is not None:
        return
    write_dataset(load_train(spark, train_folder).unionByName(load_test(spark, test_folder)), path)


def load_dataset(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """The current version of a dataset; a folder without a manifest is not one."""
    manifest = dataset_manifest(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"no complete dataset at {path}")
    reviews = spark.read.schema(REVIEW).parquet(f"{path}/{manifest['version']}")
    return reviews if split is None else reviews.where(F.col("split") == split)


def save_features(features: DataFrame, path: str, model: PipelineModel | None = None) -> None:
    """Write (id, features, rating) per split, and the fitted pipeline beside them."""
    features.select(*FEATURES.fieldNames()).write.partitionBy("split").mode("overwrite").parquet(
        f"{path}/features"
    )
    if model is not None:
        model.write().overwrite().save(f"{path}/model")


def load_features(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    features = spark.read.schema(FEATURES).parquet(f"{path}/features")
    return features if split is None else features.where(F.col("split") == split)


@F.pandas_udf(T.StringType())
def _eighteen_decimals(values: pd.Series) -> pd.Series:
    # Spark's format_string rounds the shortest decimal form, not the binary value.
    return values.map(lambda v: f"{v:.18f}")


def submission(predictions: DataFrame) -> DataFrame:
    """(id, rating) as text, 18 decimals; the id is the 1-based position of the review."""
    return predictions.select(
        F.col("id").cast("string").alias("id"),
        _eighteen_decimals(F.col("prediction").cast("double")).alias("rating"),
    )


def write_submission(predictions: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV ordered by id: ``id,rating`` header, ``|`` quote, CRLF.

    A large result stays in several files, each a range of ids with its own
    header; ``single_file`` is for a test set that one task can write.
    """
    ordered = predictions.select("id", "prediction")
    ordered = ordered.coalesce(1).sortWithinPartitions("id") if single_file else ordered.orderBy("id")
    submission(ordered).write.mode("overwrite").option("header", True).option("quote", "|").option(
        "lineSep", "\r\n"
    ).csv(path)


def write_submission_parts(predictions: DataFrame, path: str) -> None:
    """The submission of any size as parts which, joined in the order of their names, are the exact file.

    Each part is a range of ids; the header is a row before the first id. Ids and
    ratings are numbers, so nothing has to be quoted.
    """
    rows = submission(predictions.select("id", "prediction").where(F.col("id").isNotNull()))
    lines = rows.select(F.col("id").cast("long").alias("_at"), F.concat_ws(",", "id", "rating").alias("value"))
    header = predictions.sparkSession.createDataFrame([(None, "id,rating")], "_at long, value string")
    ordered = header.unionByName(lines).orderBy(F.asc_nulls_first("_at"))
    ordered.select("value").write.mode("overwrite").option("lineSep", "\r\n").text(path)


def append_predictions(predictions: DataFrame, path: str, model: str) -> None:
    predictions.select(
        F.lit(model).alias("model"), F.col("id").cast("bigint"), F.col("prediction").cast("double")
    ).select(*PREDICTIONS.fieldNames()).write.mode("append").parquet(path)


def load_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PREDICTIONS).parquet(path)


def append_trials(spark: SparkSession, rows: Sequence[dict], schema: str, path: str) -> None:
    """Add finished tuning trials to the log; one small append per call, from the driver only."""
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A small report table as CSV with header."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
