"""Order-dependent operators over a whole table, without a one-task window.

A window with no partition key sends every row to one task. These operators cut the key
space into slices, sum each slice, and add the sums of the slices before it. The input is
written once, and once more with its slices, so it is computed one time only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewharf.session import materialize, work_path
from tradewharf.sources.paths import delete_path

#: Rows a slice is meant to have; the number of slices grows with the table.
SLICE_ROWS = 1_000_000


def sliced(df: DataFrame, key: str, slices: int | None = None) -> DataFrame:
    """``df`` as a written table with ``_slice``: rows of slice *i* have smaller keys than those
    of slice *i + 1*, and equal keys share a slice.

    Spark places the borders from a sample; they steer balance, never results. Writing the
    slice numbers fixes them, so that every later reading sees the same.
    """
    spark = df.sparkSession
    path = work_path(spark, "unsliced")
    rows = materialize(df, "unsliced", path)
    if slices is None:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        slices = max(least, -(-rows.count() // SLICE_ROWS))
    numbered = rows.repartitionByRange(slices, key).withColumn("_slice", F.spark_partition_id())
    out = materialize(numbered, "sliced")
    delete_path(spark, path)
    return out


def running_total(
    df: DataFrame, order_col: str, value: Column, out: str, slices: int | None = None
) -> DataFrame:
    """``sum(value) over (order by order_col rows unbounded preceding)`` for a unique,
    non-null ``order_col``."""
    cut = sliced(df.withColumn("_v", value), order_col, slices)
    # One row per slice here; the sums of the slices before each.
    before = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(F.col("_slice").alias("_at")).agg(F.sum("_v").alias("_s"))
        .withColumn("_offset", F.coalesce(F.sum("_s").over(before), F.lit(0)))
        .drop("_s")
    )
    within = (
        Window.partitionBy("_slice").orderBy(order_col)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        cut.join(offsets, F.col("_slice") == F.col("_at"))
        .withColumn(out, (F.sum("_v").over(within) + F.col("_offset")))
        .drop("_v", "_slice", "_at", "_offset")
    )


def row_numbers(df: DataFrame, order_col: str, out: str, slices: int | None = None) -> DataFrame:
    """``row_number() over (order by order_col)`` for a unique, non-null ``order_col``."""
    numbered = running_total(df, order_col, F.lit(1).cast("bigint"), out, slices)
    return numbered.withColumn(out, F.col(out).cast("bigint"))


def cumulative_ranges(
    df: DataFrame, weight: str, order_col: str, start: str = "range_start", end: str = "range_end"
) -> DataFrame:
    """Lay the weights end to end: row *i* owns the integers [start, end]."""
    return running_total(df, order_col, F.col(weight).cast("bigint"), end).withColumns(
        {
            end: F.col(end).cast("bigint"),
            start: (F.col(end) - F.col(weight) + 1).cast("bigint"),
        }
    )


def weighted_allocation(
    draws: DataFrame, ranges: DataFrame, draw: str, start: str = "range_start", end: str = "range_end"
) -> DataFrame:
    """Join each draw to the one range that contains it.

    Ranges are spread over fixed-width blocks about as wide as the average range, so the
    join is an equi join on the block with the exact bounds as residual: at most two block
    rows per range on average, and no nested loop however many ranges there are.
    """
    size = ranges.agg(F.max(end).alias("w"), F.count(F.lit(1)).alias("n")).first()
    width = max(1, -(-int(size["w"] or 1) // max(1, int(size["n"]))))
    blocks = ranges.withColumn(
        "_block",
        F.explode(
            F.sequence(F.expr(f"{start} div {width}L"), F.expr(f"{end} div {width}L"))
        ),
    )
    d = draws.withColumn("_block", F.expr(f"{draw} div {width}L"))
    return (
        d.join(blocks, "_block")
        .where(F.col(draw).between(F.col(start), F.col(end)))
        .drop("_block")
    )


def top_n_per_row(
    rows: DataFrame, candidates: DataFrame, n_col: str, seed_col: str, candidate_key: str,
    multiplier: int = 37,
) -> DataFrame:
    """Give every row its own ``n`` distinct candidates, in a per-row rotated order.

    Candidates are numbered once. Row *r* starts at ``seed * multiplier mod count`` and takes
    the next ``n`` positions, which is "top n by (position - start) mod count" without
    pairing every row with every candidate. The pick order is returned as ``pick``.
    """
    numbered = row_numbers(candidates, candidate_key, "_pos").withColumn("_pos", F.col("_pos") - 1)
    total = int(candidates.count())
    take = F.least(F.col(n_col).cast("bigint"), F.lit(total))
    picks = rows.where(take > 0).withColumn(
        "pick", F.explode(F.sequence(F.lit(1).cast("bigint"), take))
    )
    count = F.lit(max(1, total))
    start = F.pmod(F.col(seed_col) * multiplier, count)
    return (
        picks.withColumn("_pos", F.pmod(start + F.col("pick") - 1, count))
        .join(numbered, "_pos")
        .drop("_pos")
    )


def top_ranked_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per group with their rank (``rank_in_group``).

    The bound on the rank lets the optimizer cut each group to ``n`` rows per task before
    the exchange, so a hot group is safe.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank_in_group", F.row_number().over(w)).where(F.col("rank_in_group") <= n)


def bucketed_row_number(
    df: DataFrame, keys: Sequence[str], order_col: str, bucket: Column, out: str
) -> DataFrame:
    """Row number per key, computed per (key, bucket) plus the counts of earlier buckets.

    ``bucket`` must grow with ``order_col`` (a year, a month): a hot key is then spread over
    its buckets, and only one row per bucket meets in the per-key offset window.
    """
    cut = df.withColumn("_bucket", bucket)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    within = Window.partitionBy(*keys, "_bucket").orderBy(order_col)
    return (
        cut.withColumn("_rn", F.row_number().over(within))
        .join(offsets, [*keys, "_bucket"])
        .withColumn(out, (F.col("_rn") + F.col("_offset")).cast("bigint"))
        .drop("_rn", "_offset", "_bucket")
    )


def bucketed_lead(
    df: DataFrame, keys: Sequence[str], order_col: str, bucket: Column, out: str
) -> DataFrame:
    """Next ``order_col`` value of the same key, with hot keys spread over buckets.

    Inside a bucket this is a plain lead; the last row of a bucket takes the smallest value
    of the key's next non-empty bucket.
    """
    cut = df.withColumn("_bucket", bucket)
    by_bucket = Window.partitionBy(*keys).orderBy("_bucket")
    firsts = (
        cut.groupBy(*keys, "_bucket").agg(F.min(order_col).alias("_first"))
        .withColumn("_next_first", F.lead("_first").over(by_bucket))
        .drop("_first")
    )
    within = Window.partitionBy(*keys, "_bucket").orderBy(order_col)
    return (
        cut.withColumn("_lead", F.lead(order_col).over(within))
        .join(firsts, [*keys, "_bucket"])
        .withColumn(out, F.coalesce("_lead", "_next_first"))
        .drop("_lead", "_next_first", "_bucket")
    )
