"""Mixing sources to target weights with a budget that runs down a tree.

The tree is domain, language, source. A node gets its share of the parent's tokens by weight,
but never more than its leaves can give; what it cannot take goes to its siblings by their
weights, and only what all siblings cannot take is missing one level up. A leaf fills its target
with whole epochs and, from the last one, the token prefix of a seeded order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewharf.llm.base import Scratch, row_key, space_words

SEED = "mix-1"
MAX_EPOCHS = 2
#: Share of the tokens of one epoch of everything that the mixture has.
BUDGET_PERCENT = 80
LEVELS = ("domain", "lang", "source")
#: Slices of a leaf's order; the running sum is needed within one of them only.
SLICES = 4096

#: The production tree: weights of domains and languages; others have weight 1, sources too.
WEIGHTS: dict[str, dict[str, int]] = {
    "domain": {"crawl": 3, "forum": 2, "books": 5},
    "lang": {"en": 6, "de": 2, "fr": 2, "es": 1},
    "source": {},
}


def domain_of(source: Column) -> Column:
    """The domain of a source name: src0 is the crawl, others go by their last digit."""
    digit = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9])$", 1)
    return F.when(source == "src0", "crawl").when(digit.isin("1", "2", "3", "4"), "forum").otherwise("books")


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    known = weights.get(level) or {}
    out = F.lit(1)
    for name, w in known.items():
        out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("long")


def _fill(children: DataFrame, parent: list[str], order: str) -> DataFrame:
    """``target`` for each child: min(cap, level * weight) with a common level per parent that
    uses up ``budget`` or all caps. Children are visited by cap / weight; those whose cap lies
    under the level left for them are full."""
    w = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), order) if parent else Window.orderBy(F.col("cap") / F.col("weight"), order)
    whole = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(1))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rest = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    return (
        children.withColumns({"_tw_left": left, "_tw_rest": rest})
        .withColumn("_tw_full", F.col("cap") * F.col("_tw_rest") <= F.col("_tw_left") * F.col("weight"))
        # The first child that is not full sets the level for itself and all after it.
        .withColumn("_tw_m", F.max(F.when(~F.col("_tw_full"), F.col("_tw_rest"))).over(whole))
        .withColumn("_tw_at", F.max(F.when(~F.col("_tw_full") & (F.col("_tw_rest") == F.col("_tw_m")), F.col("_tw_left"))).over(whole))
        .withColumn("target", F.when(F.col("_tw_full"), F.col("cap")).otherwise(F.expr("_tw_at * weight div _tw_m")))
        .drop("_tw_left", "_tw_rest", "_tw_full", "_tw_m", "_tw_at")
    )


def budgets(
    leaves: DataFrame, weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """Targets of the leaves; ``leaves`` has one row per (domain, lang, source) and ``tokens``.

    Works on one row per node. Integer arithmetic; rounding may leave a few tokens unused.
    """
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    total = leaves.agg((F.coalesce(F.sum("tokens"), F.lit(0)) * budget_percent).alias("b")).select(F.expr("b div 100").alias("budget"))
    parents, keys = total, []
    for level in LEVELS:
        path = [*keys, level]
        nodes = caps.groupBy(*path).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(level, weights))
        if keys:
            up = parents.select(*[F.col(k).alias(f"_tw_{k}") for k in keys], F.col("target").alias("budget"))
            same = F.lit(True)
            for k in keys:
                same = same & nodes[k].eqNullSafe(up[f"_tw_{k}"])
            nodes = nodes.join(up, same).drop(*[f"_tw_{k}" for k in keys])
        else:
            # One row on the right: the budget of the whole.
            nodes = nodes.withColumn("_tw_one", F.lit(1)).join(total.withColumn("_tw_one", F.lit(1)), "_tw_one").drop("_tw_one")
        parents, keys = _fill(nodes, keys, level), path
    return parents.select(*LEVELS, "target").join(
        leaves.select(*[F.col(k).alias(f"_tw_{k}") for k in LEVELS], "tokens"),
        F.col("domain").eqNullSafe(F.col("_tw_domain")) & F.col("lang").eqNullSafe(F.col("_tw_lang")) & F.col("source").eqNullSafe(F.col("_tw_source")),
    ).drop(*[f"_tw_{k}" for k in LEVELS])


def _slice(seed: str, epoch: Column, salt: Column) -> Column:
    return F.md5(F.concat_ws("/", F.lit(seed), epoch.cast("string"), salt))


def select_prefix(rows: DataFrame, plan: DataFrame, scratch: Scratch, seed: str = SEED) -> DataFrame:
    """``rows`` (domain, lang, source, doc_id, _tw_key, tokens, copies) plus ``epochs``, how
    often each is taken: the full epochs, and one more inside the prefix of the last.

    The running sum is cut into slices of the order: sums per slice place each slice before,
    at or beyond the end of the prefix, and rows are added up in the slice at the end only. So
    a leaf that holds a third of all rows is spread over all tasks.
    """
    named = plan.select(
        *[F.col(k).alias(f"_tw_{k}") for k in LEVELS],
        F.expr("if(tokens > 0, target div tokens, 0L)").alias("_tw_full"),
        F.expr("if(tokens > 0, target % tokens, 0L)").alias("_tw_rest"),
    )
    same = F.lit(True)
    for k in LEVELS:
        same = same & rows[k].eqNullSafe(named[f"_tw_{k}"])
    placed = rows.join(named, same).drop(*[f"_tw_{k}" for k in LEVELS])
    placed = placed.withColumn("_tw_order", _slice(seed, F.col("_tw_full"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    placed = placed.withColumns({
        "_tw_slice": F.conv(F.substring("_tw_order", 1, 3), 16, 10).cast("int"),
        "_tw_size": F.col("tokens") * F.col("copies"),
    })
    sums = placed.groupBy(*LEVELS, "_tw_slice", "_tw_rest").agg(F.sum("_tw_size").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("_tw_slice"))
    ends = sums.withColumn("_tw_before", upto - F.col("n")).where("_tw_before < _tw_rest and _tw_before + n >= _tw_rest").select(
        *[F.col(k).alias(f"_tw_{k}") for k in LEVELS], F.col("_tw_slice").alias("_tw_end"), "_tw_before"
    )
    ends = scratch.cut(ends, "ends")
    same = F.lit(True)
    for k in LEVELS:
        same = same & placed[k].eqNullSafe(ends[f"_tw_{k}"])
    placed = placed.join(ends, same, "left").drop(*[f"_tw_{k}" for k in LEVELS])
    at_end = placed.where("_tw_slice = _tw_end")
    inner = Window.partitionBy(*LEVELS).orderBy("_tw_order", "doc_id", "_tw_key").rowsBetween(Window.unboundedPreceding, -1)
    at_end = at_end.withColumn("_tw_run", F.col("_tw_before") + F.coalesce(F.sum("_tw_size").over(inner), F.lit(0)))
    at_end = at_end.withColumn("epochs", F.expr("_tw_full + if(_tw_run < _tw_rest, 1L, 0L)"))
    others = placed.where("_tw_end is null or _tw_slice <> _tw_end").withColumn(
        "epochs", F.expr("_tw_full + if(_tw_slice < _tw_end, 1L, 0L)")
    )
    return at_end.select(*rows.columns, "epochs").unionByName(others.select(*rows.columns, "epochs"))


def selection(
    docs: DataFrame, scratch: Scratch, weights=WEIGHTS, budget_percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS, seed: str = SEED,
) -> DataFrame:
    """One row per different document: domain, lang, source, doc_id, tokens, copies, epochs.

    Tokens are words between white space; a document without any is taken in full epochs only
    or inside the prefix, like any other. Equal rows are one unit of ``copies`` rows.
    """
    rows = docs.select("doc_id", "lang", "source", F.size(space_words(F.col("text"))).cast("long").alias("tokens"), row_key(F.col("text"), F.col("lang"), F.col("source")).alias("_tw_key"))
    rows = rows.groupBy("doc_id", "_tw_key", "lang", "source", "tokens").agg(F.count(F.lit(1)).alias("copies"))
    rows = scratch.cut(rows.withColumn("domain", domain_of(F.col("source"))), "rows")
    leaves = rows.groupBy(*LEVELS).agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"))
    plan = scratch.cut(budgets(scratch.cut(leaves, "leaves"), weights, budget_percent, max_epochs), "plan")
    return select_prefix(rows, plan, scratch, seed)


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixture: rows of ``docs``, each repeated once per epoch that takes it.

    No rows give no rows. Null languages and sources are leaves of their own.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    taken = scratch.cut(selection(docs, scratch, **how).where("epochs > 0").select(
        F.col("doc_id").alias("_tw_id"), F.col("_tw_key").alias("_tw_taken"), "epochs"), "taken")
    keyed = docs.withColumn("_tw_key", row_key(F.col("text"), F.col("lang"), F.col("source")))
    same = keyed.doc_id.eqNullSafe(taken._tw_id) & (keyed._tw_key == taken._tw_taken)
    joined = keyed.join(taken.withColumnRenamed("epochs", "_tw_epochs"), same)
    return joined.withColumn("_tw_epoch", F.explode(F.sequence(F.lit(1), F.col("_tw_epochs")))).select(*docs.columns)


def report(docs: DataFrame, **how) -> DataFrame:
    """One row per document row: its leaf, tokens, and in how many epochs it is taken."""
    picked = selection(docs, Scratch(docs.sparkSession, "mixing"), **how)
    return picked.withColumn("_tw_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        "doc_id", "domain", "lang", "source", "tokens", "epochs"
    )


def _sql() -> str:
    def weight(level: str) -> str:
        cases = " ".join(f"when {level} = '{n}' then {w}" for n, w in WEIGHTS[level].items())
        return f"case {cases} else 1 end" if cases else "1"

    steps, keys = [], []
    for i, level in enumerate(LEVELS):
        path = ", ".join([*keys, level])
        on = " and ".join(f"c.{k} is not distinct from p.{k}" for k in keys) or "true"
        by = f"partition by {', '.join(keys)}" if keys else ""
        steps.append(f"""
c{i} as (select c.*, p.target as budget from (select {path}, cast(sum(cap) as bigint) as cap, {weight(level)} as weight
    from leaves group by {path}) c join t{i} p on {on}),
o{i} as (select *, budget - coalesce(sum(cap) over (w rows between unbounded preceding and 1 preceding), 0) as lft,
    sum(weight) over ({by}) - coalesce(sum(weight) over (w rows between unbounded preceding and 1 preceding), 0) as rst
    from c{i} window w as ({by} order by cap / weight, {level})),
f{i} as (select *, cap * rst <= lft * weight as ful from o{i}),
m{i} as (select *, max(rst) filter (not ful) over ({by}) as m, arg_max(lft, rst) filter (not ful) over ({by}) as lv from f{i}),
t{i + 1} as (select {path}, cast(case when ful then cap else lv * weight // m end as bigint) as target from m{i})""")
        keys.append(level)
    on = " and ".join(f"d.{k} is not distinct from p.{k}" for k in LEVELS)
    return rf"""
with docs as (
    select doc_id, lang, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as tokens, text,
        case when source = 'src0' then 'crawl' when regexp_matches(source, '[1-4]$') then 'forum' else 'books' end as domain
    from documents),
leaves as (select domain, lang, source, cast(sum(tokens) as bigint) as tokens, cast(sum(tokens) * {MAX_EPOCHS} as bigint) as cap
    from docs group by all),
t0 as (select sum(tokens) * {BUDGET_PERCENT} // 100 as target from leaves),{','.join(steps)},
plan as (select p.*, d.tokens as have from t3 p join leaves d on {on}),
placed as (select d.doc_id, d.domain, d.lang, d.source, d.tokens, d.text,
    case when have > 0 then target // have else 0 end as ful, case when have > 0 then target % have else 0 end as rst
    from docs d join plan p on {on}),
run as (select *, coalesce(sum(tokens) over (partition by domain, lang, source
        order by md5('{SEED}/' || ful || '/' || coalesce(cast(doc_id as varchar), '')), doc_id, text
        rows between unbounded preceding and 1 preceding), 0) as before from placed)
select doc_id, domain, lang, source, cast(tokens as bigint) as tokens,
    cast(ful + case when before < rst then 1 else 0 end as bigint) as epochs from run
"""


SQL = _sql()
