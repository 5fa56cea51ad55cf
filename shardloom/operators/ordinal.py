"""Dense ordinals without single-task windows.

``row_number() over (partition by g order by o)`` puts a whole group in one task; a
source holding a third of the corpus would then run in one task. ``global_ordinal``
range-partitions on (group, order), numbers rows inside each partition, and adds the
count of the group's rows in earlier partitions (a table of at most
partitions + groups rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


#: Rows of the table of offsets that go to every task; a larger table is joined by a shuffle.
BROADCAST_ROWS = 100_000


def same_groups(left: str, right: str, cols: list[str]) -> Column:
    """Join condition on (_pid, groups); null groups are groups like any other."""
    on = F.col(f"{left}._pid") == F.col(f"{right}._pid")
    for c in cols:
        on = on & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return on


def global_ordinal(df: DataFrame, group_cols: list[str], order_cols: list[str],
                   out_col: str = "ordinal", num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based ``out_col`` = rank of each row by ``order_cols`` within ``group_cols``.

    Whole rows go through the one range shuffle and are written in the shared checkpoint folder,
    so partition ids and in-partition positions stay the same for both passes (counts, then
    numbering) and survive executor loss. Null groups and null or repeated order values are
    numbered like any others; rows that agree in all order columns follow a hash of the row.
    """
    keys = [*group_cols, *order_cols]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
                         .repartitionByRange(n, *keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_mid", F.monotonically_increasing_id()), "ranged")
    per_part = materialize(ranged.groupBy("_pid", *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first")), "counts")
    w = (Window.partitionBy(*group_cols).orderBy("_pid")
         .rowsBetween(Window.unboundedPreceding, -1))
    # At most (partitions + groups) rows, counted here: a small table goes to every task, so that whole rows
    # are not shuffled a second time (AQE learns its size only when they have been).
    offsets = per_part.select(
        "_pid", *group_cols, "_first",
        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    if per_part.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    out = ranged.alias("l").join(offsets.alias("r"), same_groups("l", "r", group_cols))
    return out.select("l.*", (F.col("_before") + F.col("_mid") - F.col("_first")).alias(out_col)).drop("_pid", "_mid")


def running_aggregates(df: DataFrame, group_cols: list[str], order_cols: list[str],
                       specs: list[tuple], num_partitions: int | None = None) -> DataFrame:
    """Running aggregates over ``order_cols`` inside ``group_cols`` without one task per group.

    ``specs``: (out_col, value Column, kind, exclusive) with kind in 'min', 'last' (last
    non-null value) and 'count' (non-null values); ``exclusive`` stops the frame one row
    before the current row. Rows are range partitioned on (group, order) and written to
    the checkpoint folder; each (partition, group) chunk gets its own window, and a
    carry-in from the earlier partitions (a table of at most partitions + groups rows)
    is combined with it. A group holding a third of the rows spans many partitions.
    ``order_cols`` must be unique inside a group.
    """
    keys = [*group_cols, *order_cols]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    vals = [F.col(c) for c in df.columns] + [v.alias(f"_v{i}") for i, (_, v, _, _) in enumerate(specs)]
    ranged = materialize(df.select(*vals).repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id()),
                         "running")
    summary_aggs = []
    for i, (_, _, kind, _) in enumerate(specs):
        v = F.col(f"_v{i}")
        if kind == "min":
            summary_aggs.append(F.min(v).alias(f"_s{i}"))
        elif kind == "last":
            summary_aggs.append(F.max_by(v, F.when(v.isNotNull(), F.struct(*order_cols))).alias(f"_s{i}"))
        elif kind == "count":
            summary_aggs.append(F.count(v).alias(f"_s{i}"))
        else:
            raise ValueError(kind)
    summ = ranged.groupBy("_pid", *group_cols).agg(*summary_aggs)
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carries = []
    for i, (_, _, kind, _) in enumerate(specs):
        s = F.col(f"_s{i}")
        c = (F.min(s) if kind == "min" else F.last(s, ignorenulls=True) if kind == "last" else F.sum(s)).over(before)
        carries.append(c.alias(f"_c{i}"))
    carry = summ.select("_pid", *group_cols, *carries)
    out = (ranged.alias("l").join(carry.alias("r"), same_groups("l", "r", group_cols))
           .select("l.*", *[f"r._c{i}" for i in range(len(specs))]))
    for i, (name, _, kind, exclusive) in enumerate(specs):
        w = (Window.partitionBy("_pid", *group_cols).orderBy(*order_cols)
             .rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0))
        v, c = F.col(f"_v{i}"), F.col(f"_c{i}")
        if kind == "min":
            val = F.least(F.min(v).over(w), c)
        elif kind == "last":
            val = F.coalesce(F.last(v, ignorenulls=True).over(w), c)
        else:
            val = F.coalesce(F.count(v).over(w), F.lit(0)) + F.coalesce(c, F.lit(0))
        out = out.withColumn(name, val)
    return out.drop("_pid", *[f"_v{i}" for i in range(len(specs))], *[f"_c{i}" for i in range(len(specs))])
