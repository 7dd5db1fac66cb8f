"""Point-in-time joins by merging both sides in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewharf.operators.relational import pit_join
from tradewharf.session import materialize


def _tangled(versions: DataFrame, entity: Sequence[str], lo: str, hi: str) -> DataFrame:
    """Entities of which two versions are in force on one day."""
    after = F.lead(lo).over(Window.partitionBy(*entity).orderBy(F.col(lo), F.col(hi).asc_nulls_last()))
    shared = versions.withColumn("_after", after).where(F.col("_after").isNotNull() & (F.col(hi).isNull() | (F.col(hi) >= F.col("_after"))))
    return shared.select(*entity).distinct()


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    at: str,
    lo: str = "valid_from",
    hi: str = "valid_to",
    how: str = "left",
    slice_unit: str = "month",
) -> DataFrame:
    """The rows of ``pit_join``, for entities with many versions and many events.

    An equi join with the period as residual condition compares every event of an entity with
    every version of it. Here events and versions are sorted together by (entity, slice of time),
    and each event takes the last version begun before it: one pass. What was in force when a slice
    begins is carried over from the slices before, on one row per entity and slice; so a hot entity
    is spread over its slices, and ``slice_unit`` (an argument of date_trunc) says how far.

    Entities with overlapping versions may match several and go through ``pit_join``. A NULL
    entity, date or ``lo`` matches nothing, a NULL ``hi`` is open.
    """
    entity = [r for _, r in on]
    known = F.lit(True)
    for c in (*entity, lo):
        known = known & F.col(c).isNotNull()
    usable = right.where(known & (F.col(hi).isNull() | (F.col(hi) >= F.col(lo))))
    tangled = materialize(_tangled(usable, entity, lo, hi), "asof-tangled")
    match = [left[a] == tangled[b] for a, b in on]
    plain = left.join(tangled, match, "left_anti")
    both_in_force = pit_join(left.join(tangled, match, "left_semi"), right, on, at, lo, hi, how)

    keys = [f"_e{i}" for i in range(len(on))]
    version = F.struct(*[F.col(c) for c in right.columns])
    kind = usable.select(version.alias("v")).schema["v"].dataType
    row = F.struct(*[F.col(c) for c in left.columns])
    row_kind = left.select(row.alias("r")).schema["r"].dataType
    clean = usable.join(tangled.withColumnsRenamed({b: f"_t{i}" for i, (_, b) in enumerate(on)}), [F.col(b) == F.col(f"_t{i}") for i, (_, b) in enumerate(on)], "left_anti")
    events = plain.select(*[F.col(a).alias(k) for (a, _), k in zip(on, keys)], F.col(at).alias("_t"), row.alias("_row"), F.lit(None).cast(kind).alias("_v"))
    begun = clean.select(*[F.col(b).alias(k) for (_, b), k in zip(on, keys)], F.col(lo).alias("_t"), F.lit(None).cast(row_kind).alias("_row"), version.alias("_v"))
    merged = events.unionByName(begun).withColumn("_slice", F.date_trunc(slice_unit, "_t"))

    part = [*keys, "_slice"]
    in_order = Window.partitionBy(*part).orderBy("_t", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = merged.withColumn("_here", F.last("_v", ignorenulls=True).over(in_order)).where("_row is not null")
    ends = merged.groupBy(*part).agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_t"))).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*[F.col(c).alias(f"{c}_") for c in part], F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    met = seen.join(carried, [F.col(c) == F.col(f"{c}_") for c in part], "left").withColumn("_m", F.coalesce("_here", "_carried"))
    in_force = F.col(f"_m.{hi}").isNull() | (F.col("_t") <= F.col(f"_m.{hi}"))
    met = met.withColumn("_m", F.when(F.col("_m").isNotNull() & in_force, F.col("_m")))
    if how == "inner":
        met = met.where("_m is not null")
    return met.select("_row.*", "_m.*").unionByName(both_in_force)
