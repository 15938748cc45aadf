"""Parameters and models as tables in any folder Spark can write."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """Raises when nothing was saved there."""
    try:
        return spark.read.parquet(path)
    except Exception as error:  # noqa: BLE001 - named so callers can skip models that were never fitted
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            raise FileNotFoundError(path) from error
        raise


def save_json(spark: SparkSession, values: dict, path: str) -> None:
    """A few driver-side parameters (weights, cut values) as one row."""
    save_table(spark.createDataFrame([(json.dumps(values),)], "params STRING"), path)


def load_json(spark: SparkSession, path: str) -> dict:
    return json.loads(load_table(spark, path).first()["params"])
