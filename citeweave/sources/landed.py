"""Landed look-ups and stored result pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.schemas import RESPONSES, RESULT_PAGES


def scan_responses(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Landed look-ups, failed ones included; a failed one has no usable body."""
    landed = spark.read.schema(RESPONSES).format(file_format).load(path)
    return landed.withColumn("body", F.when(F.col("status") == 200, F.col("body")))


def scan_result_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored result pages, one row per term and page."""
    return spark.read.schema(RESULT_PAGES).parquet(path)
