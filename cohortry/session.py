"""Session settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """UTC everywhere, and of equal map keys the last wins."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")
