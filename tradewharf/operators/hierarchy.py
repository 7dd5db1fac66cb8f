"""Manager chains over the employee registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewharf.operators.relational import union_frames
from tradewharf.session import materialize

PAIR = ["x", "z", "d"]


def _registry(people: DataFrame, id_col: str, code_col: str, manager_col: str) -> DataFrame:
    """id, code, manager of every row, the key ``x`` of its chain, and whether it is its code's node.

    A code names one manager, the row with the smallest id. Its chain has the code as key; other
    rows, of a repeated code or without one, are nobody's manager and are keyed by their content.
    """
    rows = people.select(
        F.col(id_col).cast("string").alias("id"), F.col(code_col).cast("string").alias("code"), F.col(manager_col).cast("string").alias("manager")
    )
    first = Window.partitionBy("code").orderBy(F.col("id").asc_nulls_last(), "manager")
    ranked = rows.withColumn("is_node", F.col("code").isNotNull() & (F.rank().over(first) == 1))
    shown = [F.coalesce(F.col(c), F.lit("\0")) for c in ("id", "code", "manager")]
    return ranked.withColumn("x", F.when(F.col("is_node"), F.col("code")).otherwise(F.concat(F.lit("\0"), F.concat_ws("\0", *shown))))


def _cut(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, loops) after the loops found so far are cut open at their smallest member.

    Who comes back to himself and meets nobody smaller is the smallest member of his loop. His
    chain ends with him, and so do all chains that meet him. ``loops`` has head, member, place
    (steps from the head, who has the last one) and length.
    """
    back = pairs.where("x = z").select(F.col("x").alias("head"), F.col("d").alias("length"))
    met = pairs.join(back, pairs.x == back["head"])
    heads = met.groupBy("head", "length").agg(F.min("z").alias("least")).where("least = head").select("head", "length")
    loops = pairs.join(heads, pairs.x == heads["head"]).where("d <= length").select("head", F.col("z").alias("member"), F.col("d").alias("place"), "length")
    loops = materialize(loops, "chain-loops")
    own = loops.select(F.col("head").alias("_x"), F.lit(0).cast("bigint").alias("_last")).distinct()
    met = pairs.join(own.select(F.col("_x").alias("_h")), F.col("z") == F.col("_h")).groupBy(F.col("x").alias("_x")).agg(F.min("d").alias("_last"))
    last = own.unionByName(met).groupBy("_x").agg(F.min("_last").alias("_last"))
    kept = pairs.join(last, F.col("x") == F.col("_x"), "left").where("_last is null or d <= _last").select(*PAIR)
    return materialize(kept, "chain-cut"), loops


def _around(pairs: DataFrame, loops: DataFrame) -> DataFrame:
    """What a chain that ended at the head of a loop still has to meet: the members between the
    head and the place where the chain came in. With c of a loop's n members met (the one at the
    chain's start among them), these are the first n - c after the head."""
    heads = loops.where("place = length").select("head", "length")
    ends = pairs.join(heads, pairs.z == heads["head"]).select("x", "head", "length", F.col("d").alias("last"))
    ends = ends.unionByName(heads.select(F.col("head").alias("x"), "head", "length", F.lit(0).cast("bigint").alias("last")))
    member = loops.select(F.col("member").alias("_member"), F.col("head").alias("_head"))
    met = pairs.select("x", "z").unionByName(ends.select("x", F.col("x").alias("z")))
    met = met.join(member, F.col("z") == F.col("_member")).groupBy(F.col("x").alias("_x")).agg(F.count(F.lit(1)).alias("c"))
    left = ends.join(met, ends.x == met._x)
    order = loops.select(F.col("head").alias("_head"), "member", "place")
    return left.join(order, (F.col("head") == F.col("_head")) & (F.col("place") <= F.col("length") - F.col("c"))).select(
        "x", F.col("member").alias("z"), (F.col("last") + F.col("place")).alias("d")
    )


def manager_chain(
    people: DataFrame,
    id_col: str = "id_number",
    code_col: str = "employee_code",
    manager_col: str = "manager_employee_code",
) -> DataFrame:
    """All (person, manager, level) pairs above each person, level 1 = direct manager.

    A chain ends at an unknown manager code or when it meets somebody already on it. A code that
    several rows have names the one with the smallest id.

    Pairs double their reach in each round: who is 2^k levels up, and everybody above them, is
    joined from the pairs known so far. A chain of a thousand levels takes ten rounds, whatever
    their number of people; each round is a written table. Loops are cut open as soon as they are
    seen, so a registry whose head is his own manager costs no more than one without.
    """
    rows = materialize(_registry(people, id_col, code_col, manager_col), "chain-people")
    nodes = rows.where("is_node").select("code", F.col("id").alias("node_id")).distinct()
    links = rows.select("x", "manager").distinct().join(nodes, F.col("manager") == F.col("code")).select("x", F.col("code").alias("z"), F.lit(1).cast("bigint").alias("d"))
    parts, loops, reach = [materialize(links, "chain-1")], [], 1
    while True:
        pairs = union_frames(parts)
        news = parts[-1].agg(F.count_if(F.col("x") == F.col("z")).alias("back"), F.count_if(F.col("d") == reach).alias("open")).first()
        if news.back:
            pairs, found = _cut(pairs)
            parts, loops = [pairs], [*loops, found]
        if not news.open:
            break
        jump = pairs.where(F.col("d") == reach).select("x", F.col("z").alias("_y"))
        above = pairs.select(F.col("x").alias("_y"), "z", (F.col("d") + reach).alias("d"))
        reach *= 2
        parts = [*parts, materialize(jump.join(above, "_y").select(*PAIR), f"chain-{reach}")]
    pairs = union_frames(parts)
    if loops:
        pairs = pairs.unionByName(_around(pairs, union_frames(loops)))
    named = nodes.select(F.col("code").alias("_code"), F.col("node_id").alias("manager_id_number"))
    return (
        rows.select("x", F.col("id").alias("id_number")).join(pairs, "x").join(named, F.col("z") == F.col("_code"))
        .select("id_number", "manager_id_number", F.col("z").alias("manager_employee_code"), F.col("d").cast("int").alias("chain_level"))
    )


def chain_revenue(people: DataFrame, chain: DataFrame, revenue: DataFrame, key: str, value: str) -> DataFrame:
    """Each manager's total over everybody below them.

    ``revenue`` has one row per person (``key`` = identity number), so the join fans out by
    chain depth only, and the sum per manager combines map-side.
    """
    return (
        chain.join(revenue.withColumnRenamed(key, "id_number"), "id_number")
        .groupBy("manager_id_number")
        .agg(F.sum(value).alias("subtree_revenue"), F.count(F.lit(1)).alias("subordinate_count"))
    )
