"""Relational operators: keep-latest, point-in-time joins, shares, orphans, unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewharf.functions import in_period, safe_ratio

def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the latest by ``order_by``, then by ``tie_breakers``.

    ``row_number() = 1`` lets the optimizer place a group limit before the exchange, so
    each task ships at most one row per key and a hot key never gathers in one task.
    A hash of the whole row settles what the listed columns leave open.
    """
    order = [F.col(c).desc_nulls_last() for c in (*order_by, *tie_breakers)]
    # VARIANT cannot be hashed or ordered; typed columns settle the tie.
    hashable = [f.name for f in df.schema.fields if f.dataType.typeName() != "variant"]
    order.append(F.xxhash64(*hashable).desc())
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def union_tagged(
    frames: Mapping[str, DataFrame],
    tag_col: str,
    columns: Sequence[str],
    renames: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """UNION ALL of branches cut to ``columns``, each tagged with its literal name.

    The tag is a literal in every branch, so a filter on it removes whole branches.
    """
    parts = [
        frame.withColumnsRenamed(dict((renames or {}).get(tag, {}))).select(
            F.lit(tag).alias(tag_col), *columns
        )
        for tag, frame in frames.items()
    ]
    return union_frames(parts)


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of many frames, paired up as a balanced tree: planning cost grows with the
    number of frames instead of its square."""
    level = list(frames)
    while len(level) > 1:
        pairs = [level[i : i + 2] for i in range(0, len(level), 2)]
        level = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return level[0]


def pit_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    at: str,
    lo: str = "valid_from",
    hi: str = "valid_to",
    how: str = "left",
) -> DataFrame:
    """Join ``left`` to the version of ``right`` in force on ``left[at]``.

    The entity columns are equi keys, so the plan is a hash or merge join with the period
    as residual condition. Right-hand columns must not clash with left-hand ones.
    """
    cond = in_period(left[at], right[lo], right[hi])
    for lcol, rcol in on:
        cond = (left[lcol] == right[rcol]) & cond
    return left.join(right, cond, how)


def rate_lookup(
    trades: DataFrame,
    rates: DataFrame,
    date_col: str = "trade_date",
    tier_col: str | None = None,
    days_from: DataFrame | None = None,
) -> DataFrame:
    """Attach the effective fee and commission rate by product and date.

    Without ``tier_col`` every matching rate joins, so overlapping rates repeat the trade.
    With it, a rate for the exact tier beats the default (NULL) tier, then the latest start
    and the highest rate win, and each trade keeps exactly one row.

    The schedule is resolved once per product, date (and tier) that occurs: as many rows as
    there are days and products, however many trades. Trades then meet it on equal keys.
    ``days_from`` is a cheaper table with at least the same products, dates and tiers.
    """
    r = rates.select(
        F.col("product_type").alias("_product"),
        F.col("broker_tier").alias("_tier"),
        "fee_rate",
        "commission_rate",
        F.col("effective_from").alias("_from"),
        F.col("effective_to").alias("_to"),
    )
    tier = F.lit(None).cast("string") if tier_col is None else F.col(tier_col)
    asked = (trades if days_from is None else days_from).select(
        F.col("product_type").alias("_asked_product"), F.col(date_col).alias("_asked_date"),
        tier.alias("_asked_tier"),
    ).distinct()
    cond = (asked["_asked_product"] == r["_product"]) & in_period(asked["_asked_date"], r["_from"], r["_to"])
    if tier_col is not None:
        cond = cond & (r["_tier"].isNull() | (r["_tier"] == asked["_asked_tier"]))
    found = asked.join(r, cond)
    if tier_col is not None:
        best = Window.partitionBy("_asked_product", "_asked_date", "_asked_tier").orderBy(
            F.col("_tier").isNull().asc(), F.col("_from").desc(), F.col("commission_rate").desc(), F.col("fee_rate").desc()
        )
        found = found.withColumn("_rn", F.row_number().over(best)).where("_rn = 1")
    found = found.select("_asked_product", "_asked_date", "_asked_tier", "fee_rate", "commission_rate")
    same = (trades["product_type"] == found["_asked_product"]) & (trades[date_col] == found["_asked_date"])
    if tier_col is not None:
        same = same & trades[tier_col].eqNullSafe(found["_asked_tier"])
    return trades.join(found, same, "left").drop("_asked_product", "_asked_date", "_asked_tier")


def latest_slice(df: DataFrame, date_col: str, per: Sequence[str] = ()) -> DataFrame:
    """Rows of the single latest date, or of the latest date of each ``per`` group."""
    if not per:
        return df.where(F.col(date_col) == df.agg(F.max(date_col)).scalar())
    last = df.groupBy(*per).agg(F.max(date_col).alias("_last"))
    return df.join(last, list(per)).where(F.col(date_col) == F.col("_last")).drop("_last")


def window_total(df: DataFrame, value: str, keys: Sequence[str], out: str) -> DataFrame:
    """``sum(value) over (partition by keys)`` without gathering a key in one task.

    The totals are pre-aggregated map-side and joined back null-safely; the detail side of
    that join stays splittable by adaptive skew handling, which a window is not.
    """
    total = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.sum(value).alias(out))
    cond = F.lit(True)
    for k in keys:
        cond = cond & df[k].eqNullSafe(total[f"_k_{k}"])
    return df.join(total, cond, "left").drop(*[f"_k_{k}" for k in keys])


def share_of_total(
    df: DataFrame, value: str, keys: Sequence[str], total: str, share: str
) -> DataFrame:
    """Add the group total and each row's share of it."""
    return window_total(df, value, keys, total).withColumn(
        share, safe_ratio(F.col(value), F.col(total))
    )


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(pk).alias("_pk"))
    return child.where(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def orphan_keys(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Keys without a parent and how many child rows carry each: the children are counted
    per key before the join, so a hot key crosses the network once."""
    per_key = child.groupBy(fk).agg(F.count(F.lit(1)).alias("row_count"))
    return orphans(per_key, parent, fk, pk)


def ensure_class_present(
    df: DataFrame, class_col: str, wanted: str, eligible: Column, order_col: str
) -> DataFrame:
    """When no row has class ``wanted``, promote the first eligible row (by ``order_col``)."""
    state = df.agg(
        F.when(
            F.count_if(F.col(class_col) == wanted) == 0, F.min(F.when(eligible, F.col(order_col)))
        )
    )
    # A scalar subquery: NULL when the class is present, so that nothing is promoted.
    promoted = F.when(F.col(order_col) == state.scalar(), F.lit(wanted))
    return df.withColumn(class_col, promoted.otherwise(F.col(class_col)))


def sample_rank(key: Column, seed: int, weight: Column | None = None) -> Column:
    """A row's place in a seeded draw: the smaller, the earlier. Without weights it is a hash of
    seed and key; with them an exponential variable of rate ``weight`` made from the hash, so that
    the chance to come next is in proportion to the weight. A weight of 0 or NULL is never drawn."""
    code = F.md5(F.concat(F.lit(f"{seed}/"), key.cast("string")))
    if weight is None:
        return code
    uniform = (F.conv(F.substring(code, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    return F.when(weight > 0, -F.log(uniform) / weight)


def sample_n(df: DataFrame, key: str, n: int, seed: int = 7, per: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """``n`` rows drawn without replacement, of all or of each ``per`` group (all rows of a smaller
    one). The same seed draws the same keys, however the rows are dealt out.

    Each task keeps its ``n`` smallest ranks. The sample of a union is the sample of the samples,
    so a draw over old and new rows needs the old sample only.
    """
    rank = sample_rank(F.col(key), seed, F.col(weight) if weight else None)
    ranked = df.withColumn("_rank", rank).where("_rank is not null")
    if not per:
        return ranked.orderBy("_rank", key).limit(n).drop("_rank")
    order = Window.partitionBy(*per).orderBy("_rank", key)
    return ranked.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n).drop("_rank", "_rn")


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)
