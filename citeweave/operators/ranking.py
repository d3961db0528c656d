"""The first rows of every group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: str, order_by: str, n: int, shares: int | None = None) -> DataFrame:
    """The first ``n`` rows of every group.

    A group is dealt by hash of ``order_by`` over ``shares`` parts, each part is ranked by itself, and
    the first rows of the parts are ranked again, so no task gets all of a hot group. A row among the first ``n`` of its group is also among the first ``n`` of
    its share, whichever share that is.
    ``shares`` is by default the number of shuffle partitions, so the relief grows with the job.
    """
    if shares is None:
        shares = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Dealt by share before the ranking: after a join on the group, all rows of a hot group would
    # else count as dealt well enough, and stay in one task.
    shared = df.withColumn("_share", F.pmod(F.xxhash64(order_by), F.lit(shares))).repartition(group, "_share")
    within_share = Window.partitionBy(group, "_share").orderBy(order_by)
    within_group = Window.partitionBy(group).orderBy(order_by)
    return (
        shared.withColumn("_rank", F.row_number().over(within_share))
        .filter(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(within_group))
        .filter(F.col("_rank") <= n)
        .drop("_rank", "_share")
    )
