"""Quality rules whose thresholds follow the corpus.

Every document gets counts; integer features of them go into quantile sketches per language
and source. A sketch is a histogram whose buckets keep the six leading bits of a value, so it
is deterministic, off by at most one part in 32, and merged by adding counts. A rule's bound is
a fence around the group's quartiles, SPREAD interquartile ranges and a constant of the feature
away; on the given tables the constant is the larger part everywhere (README). Groups too small
for quartiles use the sketch of their language, merged from its groups, or of the corpus. The
bounds are joined back to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewharf.llm.base import Scratch, row_key, space_words

RUN = 8  # words in a repeat window
#: Rows a sketch needs before its quartiles are used.
MIN_ROWS = 100
#: Fences lie this many interquartile ranges beyond the quartiles.
SPREAD = 3
#: feature -> least distance of the fence from the quartile; False: no lower fence.
FEATURES = {
    "symbols_permille": (150, False),  # symbols per 1000 words
    "word_length": (300, True),  # code points per 100 words
    "dup_lines_permille": (500, False),  # of the lines
    "repeat_permille": (280, False),  # of the words
    "shouting_permille": (150, False),  # capitals and exclamation marks among code points
}


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and features.

    Window hashes have 64 bits; they are compared within one text only. The costly search for
    the positions of repeats runs on texts that have some.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    line = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    window = ", ".join(f"_tw_h[i + {k}]" for k in range(RUN))
    return (
        docs.withColumns({"_tw_words": space_words(F.col("text")), "_tw_lines": line})
        .withColumns({
            "n_words": F.size("_tw_words").cast("long"),
            "word_chars": F.length(F.array_join("_tw_words", "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
            "_tw_n_lines": F.size("_tw_lines").cast("long"),
            "n_dup_lines": (F.size("_tw_lines") - F.size(F.array_distinct("_tw_lines"))).cast("long"),
            "_tw_shout": F.regexp_count(text, F.lit("[A-Z!]")).cast("long"),
            "_tw_chars": F.length(text).cast("long"),
            "_tw_h": F.expr(f"if(size(_tw_words) >= {RUN}, transform(_tw_words, w -> xxhash64(w)), null)"),
        })
        .drop("_tw_words", "_tw_lines")
        .withColumn("_tw_g", F.expr(f"if(_tw_h is null, null, transform(sequence(0, size(_tw_h) - {RUN}), i -> xxhash64({window})))"))
        .drop("_tw_h")
        .withColumn("_tw_g", F.expr("if(size(array_distinct(_tw_g)) < size(_tw_g), array_sort(transform(_tw_g, (g, i) -> struct(g, i))), null)"))
        # Positions of windows that have an equal neighbour in the order of hashes.
        .withColumn("_tw_p", F.expr(
            "array_sort(transform(filter(_tw_g, (x, i) -> (i > 0 and x.g = get(_tw_g, i - 1).g) "
            "or (i < size(_tw_g) - 1 and x.g = get(_tw_g, i + 1).g)), x -> x.i))"))
        .drop("_tw_g")
        # Each repeated window covers its words up to the next repeated window.
        .withColumn("n_repeat_words", F.expr(
            f"coalesce(aggregate(_tw_p, named_struct('end', -1, 'n', 0L), (s, p) -> "
            f"named_struct('end', p + {RUN}, 'n', s.n + p + {RUN} - greatest(p, s.end)), s -> s.n), 0L)"))
        .drop("_tw_p")
        .withColumns({
            "symbols_permille": _per("n_symbols", 1000, "n_words"),
            "word_length": _per("word_chars", 100, "n_words"),
            "dup_lines_permille": _per("n_dup_lines", 1000, "_tw_n_lines"),
            "repeat_permille": _per("n_repeat_words", 1000, "n_words"),
            "shouting_permille": _per("_tw_shout", 1000, "_tw_chars"),
        })
        .withColumn("base_failed", F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words"))
        .drop("_tw_n_lines", "_tw_shout", "_tw_chars")
    )


def _per(part: str, scale: int, whole: str) -> Column:
    """Integer ratio; null where the whole is empty."""
    return F.expr(f"{scale}L * {part} div nullif({whole}, 0L)")


def bucket(value: Column) -> Column:
    """The value with all but its six leading bits cleared."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(counted: DataFrame) -> DataFrame:
    """lang, source, feature, bucket, n: one row per filled bucket of a group's sketch."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FEATURES])
    return (
        counted.select("lang", "source", F.explode(pairs).alias("p"))
        .where("p.value is not null")
        .groupBy("lang", "source", F.col("p.feature").alias("feature"), bucket(F.col("p.value")).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge(sketch: DataFrame, *group: str) -> DataFrame:
    """The sketches of coarser groups: counts of equal buckets add up."""
    return sketch.groupBy(*group, "feature", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, *group: str) -> DataFrame:
    """One row per group and feature: rows, lower and upper fence. Touches buckets, not rows."""
    w = Window.partitionBy(*group, "feature")
    run = sketch.withColumns({"_tw_up": F.sum("n").over(w.orderBy("bucket")), "rows": F.sum("n").over(w)})
    q = run.groupBy(*group, "feature").agg(
        F.max("rows").alias("rows"),
        F.min(F.expr("case when 4 * _tw_up >= rows then bucket end")).alias("q1"),
        F.min(F.expr("case when 4 * _tw_up >= 3 * rows then bucket end")).alias("q3"),
    )
    slack = F.create_map(*[x for f, (s, _) in FEATURES.items() for x in (F.lit(f), F.lit(s))])[F.col("feature")]
    low = F.col("feature").isin([f for f, (_, lower) in FEATURES.items() if lower])
    reach = F.greatest(F.col("q3") - F.col("q1"), F.lit(0)) * SPREAD + slack
    return q.select(*group, "feature", "rows", F.when(low, F.col("q1") - reach).alias("lower"), (F.col("q3") + reach).alias("upper"))


def thresholds(counted: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per (lang, source) with the fences of every feature, from the finest sketch of
    at least ``min_rows`` rows: the group's, its language's, else the corpus's."""
    leaf = sketches(counted)
    by_lang = merge(leaf, "lang")
    levels = [
        fences(leaf, "lang", "source"),
        fences(by_lang, "lang").withColumnsRenamed({"rows": "l_rows", "lower": "l_lower", "upper": "l_upper", "lang": "l_lang"}),
        fences(merge(by_lang)).withColumnsRenamed({"rows": "c_rows", "lower": "c_lower", "upper": "c_upper"}),
    ]
    own, lang, corpus = levels
    both = own.join(lang.withColumnRenamed("feature", "l_feature"), own.lang.eqNullSafe(lang.l_lang) & (own.feature == F.col("l_feature"))).join(corpus, "feature")
    picked = both.select(
        "lang", "source", "feature",
        *[
            F.when(F.col("rows") >= min_rows, F.col(c)).when(F.col("l_rows") >= min_rows, F.col(f"l_{c}")).otherwise(F.col(f"c_{c}")).alias(c)
            for c in ("lower", "upper")
        ],
    )
    return picked.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("feature") == f, F.col(c))).alias(f"_tw_{f}_{c}") for f in FEATURES for c in ("lower", "upper")
    ])


def judge(counted: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """``counted`` plus ``kept``. ``counted`` is read twice and should be written.

    Null languages and sources are groups of their own. A feature that cannot be computed (a
    text without lines) is within its fences.
    """
    bounds = thresholds(counted, min_rows).withColumnsRenamed({"lang": "_tw_lang", "source": "_tw_source"})
    ok = ~F.col("base_failed")
    for f in FEATURES:
        inside = (F.col(f) <= F.col(f"_tw_{f}_upper")) & (F.col(f) >= F.coalesce(f"_tw_{f}_lower", F.col(f)))
        ok = ok & F.coalesce(inside, F.lit(True))
    joined = counted.join(bounds, counted.lang.eqNullSafe(bounds._tw_lang) & counted.source.eqNullSafe(bounds._tw_source), "left")
    return joined.withColumn("kept", ok).select(*[c for c in counted.columns if c != "kept"], "kept")


def verdicts(docs: DataFrame, scratch: Scratch, min_rows: int = MIN_ROWS) -> DataFrame:
    """One narrow row per document: id, group, counts, features, base_failed, kept."""
    counted = with_counts(docs.select("doc_id", "text", "lang", "source", row_key(F.col("text"), F.col("lang"), F.col("source")).alias("_tw_key")))
    return judge(scratch.cut(counted.drop("text"), "counts"), min_rows)


def filter_documents(docs: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """The documents that all rules keep, with their own columns.

    Equal rows share a verdict. No rows give no rows; a null text has no words and fails.
    """
    scratch = Scratch(docs.sparkSession, "quality-rules")
    bad = verdicts(docs, scratch, min_rows).where("not kept")
    bad = scratch.cut(bad.select(F.col("doc_id").alias("_tw_id"), F.col("_tw_key").alias("_tw_bad")).distinct(), "rejected")
    keyed = docs.withColumn("_tw_key", row_key(F.col("text"), F.col("lang"), F.col("source")))
    same = keyed.doc_id.eqNullSafe(bad._tw_id) & (keyed._tw_key == bad._tw_bad)
    return keyed.join(bad, same, "left_anti").select(*docs.columns)


def report(docs: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per document with its counts and the verdict."""
    return verdicts(docs, Scratch(docs.sparkSession, "quality-rules"), min_rows).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _sql() -> str:
    values = ", ".join(f"('{f}', {f})" for f in FEATURES)
    slack = ", ".join(f"('{f}', {s}, {str(low).lower()})" for f, (s, low) in FEATURES.items())

    def level(name: str, group: str) -> str:
        g = group + ", " if group else ""
        return f"""
{name}_q as (select {g}feature, bucket, n, sum(n) over (partition by {g}feature order by bucket) as up,
    sum(n) over (partition by {g}feature) as total
    from (select {g}feature, bucket, count(*) as n from longs group by {g}feature, bucket)),
{name} as (select {g}feature, total,
    case when lower then q1 - r end as lo, q3 + r as hi from (
    select *, (q3 - q1) * {SPREAD} + slack as r from (
        select {g}feature, max(total) as total, min(bucket) filter (4 * up >= total) as q1,
            min(bucket) filter (4 * up >= 3 * total) as q3 from {name}_q group by {g}feature)
        join (values {slack}) s(feature, slack, lower) using (feature)))"""

    return rf"""
with w as (
    select doc_id, lang, source, coalesce(text, '') as t, row_number() over () as rid,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls
    from documents),
grams as (select rid, i, array_to_string(ws[i + 1 : i + {RUN}], ' ') as g
    from (select rid, ws, unnest(range(len(ws) - {RUN - 1})) as i from w where len(ws) >= {RUN})),
twice as (select rid, i from (select *, count(*) over (partition by rid, g) as k from grams) where k > 1),
repeats as (select rid, count(distinct p) as n from (select rid, unnest(range(i, i + {RUN})) as p from twice) group by rid),
counts as (
    select rid, doc_id, lang, source, cast(len(ws) as bigint) as n_words, cast(length(array_to_string(ws, '')) as bigint) as word_chars,
        cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols, cast(len(ls) as bigint) as n_lines,
        cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, coalesce(n, 0) as n_repeat_words,
        len(regexp_extract_all(t, '[A-Z!]')) as shout, length(t) as chars
    from w left join repeats using (rid)),
f as (
    select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
        1000 * n_symbols // nullif(n_words, 0) as symbols_permille, 100 * word_chars // nullif(n_words, 0) as word_length,
        1000 * n_dup_lines // nullif(n_lines, 0) as dup_lines_permille, 1000 * n_repeat_words // nullif(n_words, 0) as repeat_permille,
        1000 * shout // nullif(chars, 0) as shouting_permille
    from counts),
longs as (
    select rid, lang, source, feature, value, (value >> greatest(length(bin(value)) - 6, 0)) << greatest(length(bin(value)) - 6, 0) as bucket
    from (select rid, lang, source, p.feature as feature, cast(p.value as bigint) as value
        from (select *, unnest([{', '.join(f"{{'feature': '{n}', 'value': {n}}}" for n in FEATURES)}]) as p from f))
    where value is not null),
{level('own', 'lang, source').strip()},{level('tongue', 'lang')},{level('corpus', '')},
out as (
    select distinct x.rid from longs x
    join own o on x.lang is not distinct from o.lang and x.source is not distinct from o.source and x.feature = o.feature
    join tongue l on x.lang is not distinct from l.lang and x.feature = l.feature
    join corpus c on x.feature = c.feature
    where x.value > case when o.total >= {MIN_ROWS} then o.hi when l.total >= {MIN_ROWS} then l.hi else c.hi end
        or x.value < case when o.total >= {MIN_ROWS} then o.lo when l.total >= {MIN_ROWS} then l.lo else c.lo end)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and rid not in (select rid from out) as kept from f
"""


SQL = _sql()
