"""Tables as they are in a folder or another database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def scan_papers(papers: DataFrame) -> DataFrame:
    """Id, key and flag of every paper, in insertion order."""
    return papers.select("id", "ss_id", "is_processed").orderBy("id")


def scan_table(
    spark: SparkSession,
    name: str,
    *,
    url: str | None = None,
    folder: str | None = None,
    split_column: str | None = None,
    partitions: int = 64,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A table with the schema its source declares: a JDBC table, or parquet below ``folder``.

    With ``split_column`` a JDBC table is read as ``partitions`` ranges of that column, whose
    bounds the database supplies.
    """
    if folder is not None:
        return spark.read.parquet(f"{folder}/{name}")
    if url is None:
        raise ValueError("name either a folder or a JDBC url")

    def connect(**extra):
        return spark.read.format("jdbc").option("url", url).options(**(properties or {}), **extra)

    if split_column is not None:
        ends = f"SELECT min({split_column}) AS low, max({split_column}) AS high FROM {name}"
        bounds = connect(query=ends).load().first()
        if bounds["low"] is not None:
            return connect(
                dbtable=name,
                partitionColumn=split_column,
                lowerBound=bounds["low"],
                upperBound=bounds["high"],
                numPartitions=partitions,
            ).load()
    return connect(dbtable=name).load()
