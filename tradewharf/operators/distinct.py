"""Distinct counts that can be rolled up.

Counts of distinct ids do not add up, sets of ids do. A set is kept as rows of 64 ids each: the
number of the word and a BIGINT whose bits are the ids. Words of coarser groups are the bitwise OR
of the finer ones', so days become weeks and brokers become branches without the trades. A group
with few ids has one narrow row per id at most, one with dense ids a row per 64; the OR of BIGINTs
stays in hash aggregation, where Spark's own bitmaps of 4 KB a piece would be sorted.

Several distinct counts side by side are separate aggregates put together per group, each scanning
its own column. One aggregate over all of them would repeat every row for each count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewharf.operators.relational import union_frames

WORD, BITS = "id_word", "id_bits"


def id_words(df: DataFrame, by: Sequence[str], id_col: str, sums: Mapping[str, Column] | None = None) -> DataFrame:
    """``by``, id_word, id_bits: the set of ``id_col`` (an integer, also negative) of each group.
    ``sums`` are carried along per word. A NULL id is in no set; its row keeps the group."""
    added = [F.sum(c).alias(name) for name, c in (sums or {}).items()]
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col(id_col).cast("bigint").bitwiseAND(63)).cast("int"))
    word = F.call_function("shiftright", F.col(id_col).cast("bigint"), F.lit(6))
    return df.groupBy(*by, word.alias(WORD)).agg(F.bit_or(bit).alias(BITS), *added)


def merge_words(state: DataFrame, by: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """The sets of coarser groups."""
    return state.groupBy(*by, WORD).agg(F.bit_or(BITS).alias(BITS), *[F.sum(c).alias(c) for c in sums])


def count_words(state: DataFrame, by: Sequence[str], out: str, sums: Sequence[str] = ()) -> DataFrame:
    """Distinct ids per group. ``state`` may have a word of a group in many rows."""
    counted = F.coalesce(F.sum(F.bit_count(BITS)), F.lit(0)).cast("bigint").alias(out)
    return merge_words(state, by, sums).groupBy(*by).agg(counted, *[F.sum(c).alias(c) for c in sums])


def count_nested(
    state: DataFrame, shared: Sequence[str], nested: Sequence[str], outs: Sequence[str], sums: Sequence[str] = ()
) -> DataFrame:
    """Per ``shared`` and ``nested`` group, finest grain: the sums, and how many ids the group adds
    to ``shared`` alone, to ``shared`` with the first ``nested`` column, and so on; ``outs`` names
    these numbers, one more than ``nested``. An id counts in the first row of each scope that has
    it, so the numbers of a coarser scope add up to its distinct ids.

    All scopes are prefixes of one order: one exchange by word and one sort, which may spill, serve
    them all, and no row is repeated per level."""
    counted = state
    for i, out in enumerate(outs):
        scope = Window.partitionBy(*shared, WORD, *nested[:i]).orderBy(*nested[i:], BITS)
        seen = F.coalesce(F.bit_or(BITS).over(scope.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))
        counted = counted.withColumn(out, F.bit_count(F.col(BITS).bitwiseAND(F.bitwise_not(seen))))
    totals = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in outs]
    return counted.groupBy(*shared, *nested).agg(*totals, *[F.sum(c).alias(c) for c in sums])


def count_values(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Distinct values of any type per group: each value once first, then counted."""
    return df.select(*by, value).distinct().groupBy(*by).agg(F.count(value).alias(out))


def side_by_side(frames: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """Aggregates of the same groups as columns of one table. Groups meet by grouping, where a
    NULL key is a key; a number that a group has in no frame is NULL."""
    names = [c for f in frames for c in f.columns if c not in by]
    kinds = {c: t for f in frames for c, t in f.dtypes}
    wide = [f.select(*by, *[F.col(c) if c in f.columns else F.lit(None).cast(kinds[c]).alias(c) for c in names]) for f in frames]
    return union_frames(wide).groupBy(*by).agg(*[F.max(c).alias(c) for c in names])


def distinct_counts(df: DataFrame, by: Sequence[str], counted: Mapping[str, str]) -> DataFrame:
    """Several exact distinct counts: ``counted`` maps result names to columns."""
    integral = {c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint")}
    frames = [
        count_words(id_words(df, by, c), by, out) if c in integral else count_values(df, by, c, out)
        for out, c in counted.items()
    ]
    return side_by_side(frames, by).select(*by, *counted)
