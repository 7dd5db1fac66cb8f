"""Operators on hand-made rows: nulls, ties, boundaries, hot keys, brute-force comparisons."""

import datetime as dt
import random
from decimal import Decimal as D
from types import SimpleNamespace

import pytest
import tiny
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradewharf import session
from tradewharf.functions import flag, in_period, pad_code, safe_ratio
from tradewharf.operators import asof, calendars, distinct, generators, hierarchy, ordering, quality, relational
from tradewharf.operators.hierarchy import chain_revenue, manager_chain
from tradewharf.plans import catalog_operators
from tradewharf.plans.dims import calendar_dim, default_calendar_bounds
from tradewharf.registry import MODELS, Lake, dependency_order, layer_schema
from tradewharf.schemas import LANDED, PASSTHROUGH
from tradewharf.sources import files


def d(text):
    return dt.date.fromisoformat(text)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# -- functions ------------------------------------------------------------------------------


def test_scalars(spark):
    df = spark.createDataFrame(
        [(1, 0, None, 7), (10, 4, True, 123456), (None, 2, False, 99)], "n int, den int, b boolean, k bigint"
    )
    got = df.select(
        safe_ratio(F.col("n"), F.col("den")).alias("r"),
        flag(F.col("b"), F.col("n") > 5).alias("f"),
        pad_code("X", F.col("k"), 4).alias("c"),
    ).collect()
    assert [r.r for r in got] == [None, 2.5, None]
    # A NULL comparison falls through to False.
    assert [r.f for r in got] == [False, True, False]
    # Longer keys are kept whole.
    assert [r.c for r in got] == ["X0007", "X123456", "X0099"]


def test_in_period_is_closed_on_both_ends(spark):
    df = spark.createDataFrame(
        [("2020-01-01",), ("2020-01-31",), ("2020-02-01",), ("2019-12-31",)], "t string"
    ).select(F.col("t").cast("date"))
    closed = in_period(F.col("t"), F.lit(d("2020-01-01")), F.lit(d("2020-01-31")))
    opened = in_period(F.col("t"), F.lit(d("2020-01-01")), F.lit(None).cast("date"))
    got = df.select("t", closed.alias("a"), opened.alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(True, True), (True, True), (False, True), (False, False)]


# -- relational -----------------------------------------------------------------------------


def test_dedup_latest_ties_and_null_order(spark):
    df = spark.createDataFrame(
        [("k1", 1, "a"), ("k1", 2, "a"), ("k2", 5, "a"), ("k2", 5, "b"), ("k3", None, "x"), ("k3", 1, "y"), (None, 1, "n")],
        "k string, at int, f string",
    )
    got = rows(relational.dedup_latest(df.where("k is not null"), ["k"], ["at"], ["f"]), "k", "at", "f")
    assert got == [("k1", 2, "a"), ("k2", 5, "b"), ("k3", 1, "y")]
    assert relational.dedup_latest(df.where("k is null"), ["k"], ["at"]).count() == 1
    assert relational.dedup_latest(df.limit(0), ["k"], ["at"]).count() == 0


def test_dedup_exact_copies_leave_one_row(spark):
    df = spark.createDataFrame([("k", 1, "a")] * 3, "k string, at int, f string")
    assert relational.dedup_latest(df, ["k"], ["at"], ["f"]).count() == 1


def test_dedup_plan_limits_groups_before_the_exchange(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as at")
    plan = relational.dedup_latest(df, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def _rates(spark, *r):
    return spark.createDataFrame(
        [(p, t, D("0.001"), D(c), d(a), d(b) if b else None) for p, t, c, a, b in r],
        "product_type string, broker_tier string, fee_rate decimal(9,6), commission_rate decimal(9,6), "
        "effective_from date, effective_to date",
    )


def test_rate_lookup_repeats_on_overlap_and_keeps_unmatched(spark):
    trades = spark.createDataFrame(
        [(1, "EQUITY", d("2020-06-01")), (2, "EQUITY", d("2019-01-01")), (3, "OEF", d("2020-06-01"))],
        "id int, product_type string, trade_date date",
    )
    rates = _rates(spark, ("EQUITY", None, "0.3", "2020-01-01", None), ("EQUITY", "SENIOR", "0.4", "2020-06-01", "2020-06-01"))
    got = rows(relational.rate_lookup(trades, rates).fillna(0, ["commission_rate"]), "id", "commission_rate")
    assert [i for i, _ in got] == [1, 1, 2, 3]


def test_rate_lookup_equals_the_range_join(spark):
    trades = spark.createDataFrame(
        [(i, p, d("2019-11-15") + dt.timedelta(days=9 * i)) for i in range(60) for p in ("EQUITY", "OEF")],
        "id int, product_type string, trade_date date",
    )
    rates = _rates(
        spark, ("EQUITY", None, "0.3", "2020-01-10", "2020-06-05"), ("EQUITY", None, "0.2", "2020-06-06", None),
        ("OEF", None, "0.5", "2021-03-31", None), ("OEF", None, "0.1", "2020-02-02", "2020-02-20"),
    )
    cols = ("id", "product_type", "commission_rate")
    on = (trades.product_type == rates.product_type) & (trades.trade_date >= rates.effective_from) & (
        trades.trade_date <= F.coalesce(rates.effective_to, F.lit(d("9999-12-31"))))
    want = rows(trades.join(rates, on, "left").drop(rates.product_type).fillna({"commission_rate": -1}), *cols)
    got = rows(relational.rate_lookup(trades, rates).fillna({"commission_rate": -1}), *cols)
    assert got == want and len({c for _, _, c in want}) == 5


def test_rate_lookup_prefers_the_exact_tier(spark):
    trades = spark.createDataFrame(
        [("a", "EQUITY", d("2020-06-01"), "SENIOR"), ("b", "EQUITY", d("2020-06-01"), "STANDARD"), ("c", "OEF", d("2020-06-01"), None)],
        "_row string, product_type string, trade_date date, tier string",
    )
    rates = _rates(spark, ("EQUITY", None, "0.3", "2020-01-01", None), ("EQUITY", "SENIOR", "0.4", "2020-01-01", None))
    got = {r["_row"]: r.commission_rate for r in relational.rate_lookup(trades, rates, tier_col="tier").collect()}
    assert got == {"a": D("0.4"), "b": D("0.3"), "c": None}


def test_pit_join_boundaries_and_no_nested_loop(spark):
    history = spark.createDataFrame(
        [("c", "x", d("2020-01-01"), d("2020-01-31")), ("c", "y", d("2020-02-01"), None)],
        "cust string, broker string, valid_from date, valid_to date",
    )
    days = spark.createDataFrame(
        [("c", d("2020-01-31")), ("c", d("2020-02-01")), ("c", d("2019-12-31")), ("z", d("2020-02-01"))],
        "customer string, day date",
    )
    out = relational.pit_join(days, history, [("customer", "cust")], "day")
    got = {(r.customer, str(r.day)): r.broker for r in out.collect()}
    assert got == {("c", "2020-01-31"): "x", ("c", "2020-02-01"): "y", ("c", "2019-12-31"): None, ("z", "2020-02-01"): None}
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_window_total_counts_null_keys_as_a_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5), (None, 6)], "k string, v int")
    got = rows(relational.window_total(df, "v", ["k"], "t").fillna("-"), "k", "v", "t")
    assert got == [("-", 5, 11), ("-", 6, 11), ("a", 1, 3), ("a", 2, 3)]


def test_share_of_zero_total_is_null(spark):
    df = spark.createDataFrame([("a", 0), ("b", 3)], "k string, v int")
    got = {r.k: r.s for r in relational.share_of_total(df, "v", ["k"], "t", "s").collect()}
    assert got == {"a": None, "b": 1.0}


def test_latest_slice_global_and_per_group(spark):
    df = spark.createDataFrame(
        [("E", d("2020-01-02")), ("E", d("2020-01-01")), ("D", d("2020-01-01"))], "p string, day date"
    )
    assert rows(relational.latest_slice(df, "day"), "p") == [("E",)]
    assert rows(relational.latest_slice(df, "day", ["p"]), "p") == [("D",), ("E",)]


def test_orphans_skip_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    assert rows(relational.orphans(child, parent, "fk", "pk"), "fk") == [(2,)]


def test_ensure_class_present(spark):
    df = spark.createDataFrame([("b2", "X", "B"), ("b1", "X", "B"), ("a0", "X", "C")], "code string, cls string, kind string")
    out = relational.ensure_class_present(df, "cls", "VIP", F.col("kind") == "B", "code")
    assert rows(out, "code", "cls") == [("a0", "X"), ("b1", "VIP"), ("b2", "X")]
    same = relational.ensure_class_present(df, "cls", "X", F.col("kind") == "B", "code")
    assert rows(same, "cls") == [("X",)] * 3


# -- order without one-task windows -------------------------------------------------------------


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-1000, 1000), st.integers(1, 50)), min_size=1, max_size=40, unique_by=lambda x: x[0]))
def test_running_total_equals_window(spark, data):
    df = spark.createDataFrame(data, "k int, w int")
    got = rows(ordering.running_total(df, "k", F.col("w"), "t", slices=5), "k", "t")
    total, want = 0, []
    for k, w in sorted(data):
        total += w
        want.append((k, total))
    assert got == want


def test_running_total_on_text_keys_and_empty_input(spark):
    df = spark.range(500).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("k"))
    got = rows(ordering.row_numbers(df, "k", "n", slices=16), "k", "n")
    assert got == [(k, i + 1) for i, k in enumerate(sorted(f"K{i}" for i in range(500)))]
    assert ordering.row_numbers(df.limit(0), "k", "n").count() == 0


def test_running_total_over_more_slices_than_256(spark):
    df = spark.range(3000).selectExpr("id * 7 as k", "id % 5 as w")
    got = rows(ordering.running_total(df, "k", F.col("w"), "t", slices=700), "k", "t")
    want, total = [], 0
    for i in range(3000):
        total += i % 5
        want.append((i * 7, total))
    assert got == want


def test_running_total_has_no_one_task_window_over_rows(spark):
    df = spark.range(1000).toDF("k")
    plan = ordering.row_numbers(df, "k", "n", slices=4)._jdf.queryExecution().executedPlan().toString()
    # The only single-partition exchange is that of the per-slice sums, behind an aggregate.
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert part.lstrip().split("\n")[1].strip(" +-:").startswith("HashAggregate")


def test_weighted_allocation_equals_range_join_with_a_huge_weight(spark):
    w = [("a", 1), ("b", 5000), ("c", 1), ("d", 3), ("e", 1)]
    ranges = ordering.cumulative_ranges(spark.createDataFrame(w, "o string, weight int"), "weight", "o")
    total = sum(x for _, x in w)
    draws = spark.range(1, total + 1).toDF("draw")
    got = {r.o: r["count"] for r in ordering.weighted_allocation(draws, ranges, "draw").groupBy("o").count().collect()}
    assert got == dict(w)


def test_top_n_gives_distinct_candidates(spark):
    people = spark.createDataFrame([(1, 3), (2, 99), (3, 0)], "id bigint, n int")
    candidates = spark.createDataFrame([(f"s{i}",) for i in range(5)], "s string")
    got = ordering.top_n_per_row(people, candidates, "n", "id", "s")
    per = {}
    for r in got.collect():
        per.setdefault(r.id, []).append(r.s)
    assert sorted(len(v) for v in per.values()) == [3, 5]
    assert all(len(set(v)) == len(v) for v in per.values())


def test_bucketed_lead_and_row_number_equal_windows(spark):
    data = [("hot", d("2000-01-01") + dt.timedelta(days=17 * i)) for i in range(200)]
    data += [("cold", d("2001-05-05")), ("cold", d("2010-01-01"))]
    df = spark.createDataFrame(data, "k string, day date")
    w = Window.partitionBy("k").orderBy("day")
    want = df.withColumns({"nx": F.lead("day").over(w), "rn": F.row_number().over(w).cast("bigint")})
    lead = ordering.bucketed_lead(df, ["k"], "day", F.year("day"), "nx")
    number = ordering.bucketed_row_number(df, ["k"], "day", F.year("day"), "rn")
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(rows(lead.withColumn("nx", F.col("nx").cast("string")).fillna("-"), "k", "day", "nx"), key=key) == sorted(
        rows(want.withColumn("nx", F.col("nx").cast("string")).fillna("-"), "k", "day", "nx"), key=key
    )
    assert rows(number, "k", "day", "rn") == rows(want, "k", "day", "rn")


# -- calendars, generators --------------------------------------------------------------------


def test_calendar_dimension(spark):
    df = calendar_dim(default_calendar_bounds(spark))
    assert df.count() == 4018
    row = df.where("date_key = date'2027-01-03'").first()
    assert (row.day_name, row.day_of_week, row.week_of_year, row.is_weekend) == ("Sun", 0, 53, True)


def test_trading_days_half_open(spark):
    bounds = calendars.fixed_bounds(spark, d("2027-01-01"), d("2027-02-01"))
    days = calendars.trading_days(bounds, "start_date", "end_date")
    assert days.count() == 21 and days.agg(F.max("trading_day")).first()[0] == d("2027-01-29")
    empty = calendars.fixed_bounds(spark, d("2027-01-01"), d("2027-01-01"))
    assert calendars.trading_days(empty, "start_date", "end_date").count() == 0


def test_mark_to_market_falls_back(spark):
    held = spark.createDataFrame([(1, D("10"), D("2.5")), (2, D("10"), D("2.5"))], "s int, quantity decimal(18,0), cost decimal(18,4)")
    prices = spark.createDataFrame([(1, D("3.33"))], "s int, price decimal(18,2)")
    got = rows(calendars.mark_to_market(held, prices, ["s"], "price", "cost"), "s", "market_value")
    assert got == [(1, D("33.30")), (2, D("25.00"))]


def test_margin_flag_boundary(spark):
    df = spark.createDataFrame([(D("0.1499"),), (D("0.15"),), (None,)], "margin_ratio decimal(9,4)")
    assert [r.call_margin_flag for r in generators.margin_flags(df).collect()] == [True, False, False]


def test_enrichment(spark):
    base = spark.createDataFrame(
        [(d("2027-01-29"), D(100), D("32.55"), "SELL", D(100000), D("28500"), D("10000000"))],
        "trade_date date, quantity decimal(18,0), price decimal(18,2), side string, multiplier decimal(18,2), "
        "nav_price decimal(18,4), amount decimal(20,2)",
    )
    e = generators.enrich_trades(base.drop("amount"), "EQUITY").first()
    assert (e.amount, e.fee_amount, e.tax_amount, e.settlement_date) == (D("3255.00"), D("4.88"), D("3.26"), d("2027-01-31"))
    v = generators.enrich_trades(base.drop("amount"), "DERIVATIVES").first()
    assert (v.amount, v.margin_amount, v.fee_amount) == (D("325500000.00"), D("48825000.00"), D("65100.00"))
    o = generators.enrich_trades(base, "OEF").first()
    assert (o.quantity_unit, o.fee_amount, o.settlement_date) == (D("350.8772"), D("0.00"), d("2027-02-01"))


def test_contract_calendar(spark):
    got = generators.contract_calendar(
        calendars.fixed_bounds(spark, d("2026-11-01"), d("2027-09-01")), "start_date", "end_date", "VN30F"
    ).orderBy("contract_month").collect()
    assert len(got) == 10
    assert (got[0].contract_code, got[0].listing_date, got[0].maturity_date) == ("VN30F2611", d("2026-08-01"), d("2026-11-30"))


# -- hierarchy --------------------------------------------------------------------------------


def _people(spark, *p):
    return spark.createDataFrame(list(p), "id_number string, employee_code string, manager_employee_code string")


def test_manager_chain_cycle_unknown_and_self(spark):
    people = _people(
        spark, ("1", "A", "B"), ("2", "B", "A"), ("3", "C", "GONE"), ("4", "D", "D"), ("5", None, None), ("6", "F", "A")
    )
    got = rows(manager_chain(people), "id_number", "chain_level", "manager_id_number")
    assert got == [("1", 1, "2"), ("2", 1, "1"), ("6", 1, "1"), ("6", 2, "2")]


def test_manager_chain_has_no_depth_limit(spark):
    people = _people(spark, *[(str(i), f"E{i}", f"E{i + 1}") for i in range(71)])
    assert manager_chain(people).where("id_number = '0'").count() == 70


def _walk(people):
    """(id, level, manager id) by following codes one by one."""
    by_code = {}
    for i, code, manager in people:
        if code is not None and (code not in by_code or i < by_code[code][0]):
            by_code[code] = (i, manager)
    out = []
    for i, code, manager in people:
        seen = {code} if code is not None and by_code[code] == (i, manager) else set()
        level = 1
        while manager in by_code and manager not in seen:
            seen.add(manager)
            out.append((i, level, by_code[manager][0]))
            manager, level = by_code[manager][1], level + 1
    return out


@pytest.mark.parametrize("seed", range(4))
def test_manager_chain_against_walks(spark, seed):
    """Random registries: loops of all lengths, tails into them, repeated, missing and unknown codes."""
    rng = random.Random(seed)
    n = [12, 40, 60, 60][seed]
    people = [(f"i{i:03d}", f"c{rng.randrange(n) if seed % 2 else i}", f"c{rng.randrange(n + 3)}") for i in range(n)]
    people += [("x1", None, "c1"), ("x2", None, None), ("x3", "c1", "c2"), ("x3", "c1", "c5"), ("loop", "L", "L"), ("below", "B", "L")]
    got = sorted(tuple(r) for r in manager_chain(_people(spark, *people)).select("id_number", "chain_level", "manager_id_number").collect())
    assert got == sorted(_walk(people))


def test_thousand_levels_take_ten_rounds(spark, monkeypatch):
    tables, real = [], hierarchy.materialize
    monkeypatch.setattr(hierarchy, "materialize", lambda df, label: (tables.append(label), real(df, label))[1])
    people = _people(spark, *[(f"{i:04d}", f"c{i}", f"c{i + 1}") for i in range(1001)], ("boss", "c1001", "c1001"))
    chain = manager_chain(people)
    assert chain.where("id_number = '0000'").agg(F.max("chain_level")).first()[0] == 1001
    assert sum(t.startswith("chain-") and t[6:].isdigit() for t in tables) <= 11


def test_distinct_words(spark):
    ids = [None, 0, 1, 63, 64, -1, -64, -65, 2**62, -(2**63), 2**63 - 1, 1, 64]
    df = spark.createDataFrame([(i % 2, x, f"{i % 3}") for i, x in enumerate(ids)] + [(None, 5, None), (7, None, "a")], "g int, id bigint, s string")
    out = distinct.distinct_counts(df, ["g"], {"ids": "id", "texts": "s"})
    want = df.groupBy("g").agg(F.count_distinct("id").alias("ids"), F.count_distinct("s").alias("texts"))
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    words = distinct.id_words(df, ["g"], "id")
    assert distinct.count_words(words, [], "ids").first().ids == 11


@pytest.mark.parametrize("name", ["rpt_department_branch_ranking", "commission_calendar", "commission_rollup"])
def test_distinct_counts_do_not_expand(spark, name, capsys):
    Lake(spark, {**tiny.sources(spark), "calendar_bounds": default_calendar_bounds(spark)})[name].explain()
    assert "Expand" not in capsys.readouterr().out


def test_nested_counts(spark):
    """Every level against count distinct: ids that repeat across units, days and products, NULLs."""
    draw = random.Random(5)
    data = [
        (draw.choice([1, 1, 2, None]), draw.choice(["a", "b", None]), draw.choice(["x", "y", "z", None]),
         draw.randrange(6), draw.choice([None, -1, 0, 63, 64, -(2**63), 2**63 - 1, *range(100, 130)]), draw.randrange(9))
        for _ in range(400)
    ]
    df = spark.createDataFrame(data, "q int, unit string, who string, day int, id bigint, v int")
    words = distinct.id_words(df, ["q", "unit", "who", "day"], "id", {"v": F.col("v")})
    out = distinct.count_nested(words, ["q"], ["unit", "who"], ["n0", "n1", "n2"], ["v"])
    for n, by in enumerate((["q"], ["q", "unit"], ["q", "unit", "who"])):
        got = out.groupBy(*by).agg(F.sum(f"n{n}").alias("n"), F.sum("v").alias("v"))
        want = df.groupBy(*by).agg(F.count_distinct("id").alias("n"), F.sum("v").alias("v"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_rollup_expands_no_sets(spark, capsys):
    Lake(spark, tiny.sources(spark))["commission_rollup"].explain()
    generated = [line for line in capsys.readouterr().out.splitlines() if "Generate explode" in line]
    assert generated and not [line for line in generated if distinct.WORD in line or distinct.BITS in line]


def test_manager_chain_of_nobody(spark):
    assert manager_chain(_people(spark, ("1", "A", None))).count() == 0


def test_chain_revenue(spark):
    people = _people(spark, ("1", "A", "B"), ("2", "B", "C"), ("3", "C", None))
    revenue = spark.createDataFrame([("1", 10), ("2", 5)], "who string, fee int")
    out = chain_revenue(people, manager_chain(people), revenue, "who", "fee")
    assert rows(out, "manager_id_number", "subtree_revenue") == [("2", 10), ("3", 15)]


# -- quality ------------------------------------------------------------------------------------


@pytest.fixture()
def tables(spark):
    t = spark.createDataFrame(
        [(1, "BUY", D("5"), dt.datetime(2020, 1, 1)), (1, "HOLD", D("-1"), dt.datetime(2020, 1, 2)), (None, None, None, None)],
        "id int, side string, v decimal(9,2), at timestamp_ntz",
    )
    return {"t": t, "p": spark.createDataFrame([(2,)], "id int"), "empty": t.limit(0)}


@pytest.mark.parametrize(
    "check,observed,status",
    [
        (quality.Check("t", "row_count"), 3, "pass"),
        (quality.Check("empty", "row_count"), 0, "fail"),
        (quality.Check("t", "missing", ("id",)), 1, "fail"),
        (quality.Check("empty", "missing", ("id",)), 0, "pass"),
        (quality.Check("t", "duplicates", ("id",)), 1, "fail"),
        (quality.Check("t", "duplicates", ("id", "side")), 0, "pass"),
        (quality.Check("t", "accepted_values", ("side",), values=("BUY", "SELL")), 1, "fail"),
        (quality.Check("t", "accepted_values", ("side",), values=("BUY", "HOLD")), 0, "pass"),
        (quality.Check("t", "non_negative", ("v",)), 1, "fail"),
        (quality.Check("t", "orphans", ("id",), parent="p", parent_key="id"), 2, "fail"),
        (quality.Check("p", "orphans", ("id",), parent="p", parent_key="id"), 0, "pass"),
        (quality.Check("t", "constraint", expr="side <> 'HOLD'"), 1, "fail"),
        (quality.Check("t", "freshness", ("at",), warn_hours=26, fail_hours=50), 24, "pass"),
        (quality.Check("t", "freshness", ("at",), warn_hours=20, fail_hours=50), 24, "warn"),
        (quality.Check("t", "freshness", ("at",), warn_hours=10, fail_hours=20), 24, "fail"),
        (quality.Check("t", "freshness", ("at",), fail_hours=24), 24, "fail"),
        (quality.Check("t", "freshness", ("at",), fail_hours=25), 24, "pass"),
        (quality.Check("empty", "freshness", ("at",), fail_hours=20), None, "fail"),
    ],
)
def test_check(tables, check, observed, status):
    (row,) = quality.run_checks(tables, [check], dt.datetime(2020, 1, 3)).collect()
    assert (row.observed, row.status) == (observed, status)


def test_null_tiers_count_as_equal_only_under_a_condition(spark):
    t = {"f": spark.createDataFrame([("E", None, True), ("E", None, True), ("E", None, False)], "p string, tier string, cur boolean")}
    at = dt.datetime(2020, 1, 1)
    plain, cond = quality.run_checks(
        t, [quality.Check("f", "duplicates", ("p", "tier")), quality.Check("f", "duplicates", ("p", "tier"), where="cur", name="current")], at
    ).orderBy("check_name").collect()
    assert {plain.check_name: plain.observed, cond.check_name: cond.observed} == {"current": 1, "duplicates": 0}


def test_unknown_column_and_gate(tables):
    at = dt.datetime(2020, 1, 3)
    with pytest.raises(ValueError, match="no_col"):
        quality.run_checks(tables, [quality.Check("t", "missing", ("no_col",))], at)
    with pytest.raises(quality.QualityError, match="missing=1"):
        quality.gate(quality.run_checks(tables, [quality.Check("t", "missing", ("id",))], at))
    quality.gate(quality.run_checks(tables, [quality.Check("t", "row_count")], at))
    with pytest.raises(quality.QualityError, match="empty"):
        quality.require_rows(t=tables["t"], empty=tables["empty"])


def _plans_of(monkeypatch):
    """What ``run_checks`` is asked for from here on: the tables, and the plan that ran."""
    asked, run = [], quality.run_checks

    def seen(tables, checks, as_of):
        df = run(tables, checks, as_of)
        df.collect()
        asked.append(({c.table for c in checks}, df._jdf.queryExecution().executedPlan().toString()))
        return df

    monkeypatch.setattr(quality, "run_checks", seen)
    return asked


def test_written_checks_run_by_table_and_broadcast_by_measured_size(spark, tmp_path, monkeypatch):
    # Files of about 0.5 MB; with the text that is made from the keys more than the 10 MB of the limit.
    spark.range(120_000).coalesce(1).write.parquet(f"{tmp_path}/keys")
    keys = spark.read.parquet(f"{tmp_path}/keys").select("id", F.repeat(F.col("id").cast("string"), 40).alias("text"))
    few = spark.createDataFrame([(1, 1), (1, 2), (None, 3)], "id bigint, v int")
    many = spark.range(1_000_000).withColumn("v", F.lit(1))
    tables = {"few": few, "wide": many.join(keys, "id"), "small": many.join(spark.range(50_000), "id")}
    checks = [
        quality.Check("few", "missing", ("id",)), quality.Check("wide", "missing", ("text",)),
        quality.Check("small", "row_count"), quality.Check("few", "duplicates", ("id",)),
    ]
    at, report = dt.datetime(2020, 1, 3), ("table_name", "check_name", "column_name", "observed", "status")
    expected = rows(quality.run_checks(tables, checks, at), *report)
    before = spark.conf.get(session.BROADCAST), spark.conf.get(session.MEASURED, None)
    asked = _plans_of(monkeypatch)
    assert rows(quality.write_checks(tables, checks, at), *report) == expected
    plans = {min(names): plan.split("== Initial Plan ==")[0] for names, plan in asked if len(names) == 1}
    assert set(plans) == {"few", "wide", "small"} and len(asked) == 3
    assert "SortMergeJoin" in plans["wide"] and "BroadcastHashJoin" not in plans["wide"]
    assert "BroadcastHashJoin" in plans["small"]
    assert (spark.conf.get(session.BROADCAST), spark.conf.get(session.MEASURED, None)) == before
    with pytest.raises(ValueError), session.measured_broadcasts(spark):
        raise ValueError
    assert (spark.conf.get(session.BROADCAST), spark.conf.get(session.MEASURED, None)) == before


def test_report_of_the_lake_runs_by_table(spark, monkeypatch):
    asked = _plans_of(monkeypatch)
    few = spark.createDataFrame([(1,), (1,), (None,)], "id bigint")
    checks = [quality.Check("t", "missing", ("id",)), quality.Check("u", "row_count"), quality.Check("u", "duplicates", ("id",))]
    monkeypatch.setattr(catalog_operators, "GOLD_CHECKS", checks)
    report = catalog_operators.dq_report(SimpleNamespace(lake=lambda as_of: {"t": few, "u": few}))
    assert rows(report, "table_name", "observed", "status") == [("t", 1, "fail"), ("u", 1, "fail"), ("u", 3, "pass")]
    assert sorted(map(sorted, (names for names, _ in asked))) == [["t"], ["u"]]


def test_anomaly(spark):
    days = [d("2020-01-01") + dt.timedelta(days=i) for i in range(10)]
    data = [(x,) for i, x in enumerate(days) for _ in range(50 if i == 9 else 10 + i % 2)]
    got = quality.rowcount_anomalies(spark.createDataFrame(data, "day date"), "day").where("is_anomaly").collect()
    assert [r.day for r in got] == [days[9]]


# -- registry, landing, session -------------------------------------------------------------------


def test_catalogue_counts():
    staged = [n for n in MODELS if n.startswith("stg_")]
    assert len(PASSTHROUGH) == 23 and len(LANDED) == 11 and len(staged) == 34
    assert len([n for n in MODELS if n.startswith("fact_")]) == 6
    assert len([n for n in MODELS if n.startswith("rpt_")]) == 13
    assert layer_schema(" stg_equity ") == "STG_EQUITY"


def test_dependency_order():
    order = dependency_order(["rpt_aum_summary"])
    assert order.index("stg_common__customer") < order.index("dim_customer") < order.index("rpt_aum_summary")


def test_strict_cast_raises_and_lenient_is_null(spark):
    raw = files.land_variant(
        spark.createDataFrame([("x",), ("12",)], "n string"), F.lit(dt.datetime(2020, 1, 1)), F.lit("f")
    )
    assert rows(files.flatten_variant(raw, {"n": "bigint"}).fillna(-1), "n") == [(-1,), (12,)]
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        files.flatten_variant(raw, {"n": "bigint"}, strict=True).collect()


def test_quarantine_keeps_the_payload_and_names_the_fields(spark):
    text = ['{"id": 1, "n": 5, "day": "2020-01-01"}', '{"id": 2, "n": "x", "day": "never"}', '{"id": 3}', '{"id": "4", "n": "7"}']
    raw = files.land_json(
        spark.createDataFrame([(t,) for t in text], "t string"), "t", F.lit(dt.datetime(2020, 1, 1)), F.lit("f")
    )
    good, bad = files.split_bad_casts(raw, {"id": "bigint", "n": "int", "day": "date"})
    assert [(r.id, r.n) for r in good.orderBy("id").collect()] == [(1, 5), (3, None), (4, 7)]
    (row,) = bad.collect()
    assert row.bad_fields == "n,day" and "never" in str(row.raw_data)


def test_heavy_tables_are_all_landed(spark, tmp_path):
    from tradewharf.schemas import SELECTED_STREAMS

    tables = {f"{s.domain}.{s.table}": spark.range(2) for s in LANDED}
    at = F.lit(dt.datetime(2020, 1, 1))
    paths = files.land_heavy_tables(tables, str(tmp_path), at, F.lit("f"))
    assert len(paths) == 11 and spark.read.parquet(paths["oef.oef_trade"]).count() == 2
    del tables["oef.oef_trade"]
    with pytest.raises(ValueError, match="oef.oef_trade"):
        files.land_heavy_tables(tables, str(tmp_path), at, F.lit("f"))
    # 26 replicated table names and the employee registry.
    assert len(SELECTED_STREAMS) == 27 and files.require_streams(SELECTED_STREAMS) == SELECTED_STREAMS
    with pytest.raises(ValueError, match="equity_trade"):
        files.require_streams(set(SELECTED_STREAMS) - {"equity_trade"})


def test_json_landing_payload_cases(spark):
    text = [
        '{"id": 1, "at": "2027-01-03T10:00:00.000Z", "amount": 10.25, "new_field": true}',
        '{"id": 2, "amount": "12.50"}',
        "not json",
    ]
    raw = files.land_json(
        spark.createDataFrame([(t,) for t in text], "t string"), "t", F.lit(dt.datetime(2020, 1, 1)), F.lit("f")
    )
    got = files.flatten_variant(raw, {"id": "bigint", "at": "timestamp", "amount": "decimal(20,2)"}).collect()
    by_id = {r.id: r for r in got}
    assert by_id[1].at == dt.datetime(2027, 1, 3, 10) and by_id[1].amount == D("10.25")
    assert by_id[2].at is None and by_id[2].amount == D("12.50") and by_id[None].amount is None


def test_surrogate_ids_repeat_and_stay_in_range(spark):
    df = spark.range(1000).select(files.surrogate_id(F.col("id").cast("string"), 100).alias("s"))
    assert rows(df, "s") == rows(df, "s") and df.where("s < 0 or s >= 100").count() == 0


def test_registry_filters(spark):
    people = spark.createDataFrame([("1", "ACTIVE"), ("2", "LEFT")], "id_number string, status string")
    assert files.filter_registry(people, status=None).count() == 2
    assert rows(files.filter_registry(people, status="LEFT"), "id_number") == [("2",)]
    assert files.lookup_person(people, "9").count() == 0


def test_work_folder_is_the_sessions():
    def at(**conf):
        return session.work_root(SimpleNamespace(conf=SimpleNamespace(get=lambda k, *_: conf.get(k.split(".")[-2]))))

    assert at(checkpoint="hdfs://shared/ck/", warehouse="hdfs://wh") == "hdfs://shared/ck"
    assert at(warehouse="hdfs://wh/") == "hdfs://wh/_work"


# -- merging in time, drawing, reconciling ---------------------------------------------------------


@pytest.mark.parametrize("unit", ["week", "month", "year"])
def test_asof_join_against_the_period_join(spark, unit):
    """Random histories: gaps, open ends, overlaps of some entities, NULLs everywhere."""
    rng = random.Random(unit)
    first = dt.date(2020, 1, 1)
    versions = []
    for e in range(12):
        day = first
        for k in range(rng.randrange(0, 12)):
            day += dt.timedelta(rng.randrange(1, 60))
            end = day + dt.timedelta(rng.randrange(-1, 50))
            versions.append((f"e{e}", day, rng.choice([end, end, end, None if e > 8 else end]), k))
            day = end if e < 9 else day
    versions += [(None, first, None, 1), ("e1", None, None, 1)]
    events = [(rng.choice([*(f"e{e}" for e in range(14)), None]), rng.choice([None, *[first + dt.timedelta(rng.randrange(700))] * 9]), i) for i in range(500)]
    left = spark.createDataFrame(events, "who string, day date, i int")
    right = spark.createDataFrame(versions, "entity string, valid_from date, valid_to date, v int")
    for how in ("left", "inner"):
        got = asof.asof_join(left, right, [("who", "entity")], "day", how=how, slice_unit=unit)
        want = relational.pit_join(left, right, [("who", "entity")], "day", how=how)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_asof_join_of_a_hot_entity(spark, capsys):
    """Ten thousand versions and a hundred thousand events of one customer, without a range condition."""
    right = spark.range(10_000).selectExpr("'c' as entity", "date_add(date'1990-01-01', cast(id as int)) as valid_from", "date_add(date'1990-01-01', cast(id as int)) as valid_to", "id as v")
    left = spark.range(100_000).selectExpr("'c' as who", "date_add(date'1990-01-01', cast(id % 10010 as int)) as day", "id as i")
    out = asof.asof_join(left, right, [("who", "entity")], "day", slice_unit="year")
    assert out.agg(F.count("v"), F.count("i"), F.count_if(F.col("v") == F.col("i") % 10010)).first()[:] == (99_910, 100_000, 99_910)


def test_sample_is_uniform_and_weighted(spark):
    df = spark.range(400).selectExpr("id", "id % 4 as g", "cast(if(id < 100, 3, 1) as double) as w")
    hits, heavy = {}, 0
    for seed in range(60):
        got = [r.id for r in relational.sample_n(df, "id", 40, seed).collect()]
        assert len(set(got)) == 40
        for i in got:
            hits[i] = hits.get(i, 0) + 1
        heavy += sum(r.id < 100 for r in relational.sample_n(df, "id", 40, seed, weight="w").collect())
    # 6 draws expected each; 400 counts around it with the spread of a binomial.
    mean = sum(hits.values()) / 400
    spread = sum((hits.get(i, 0) - mean) ** 2 for i in range(400)) / 400
    assert mean == 6 and 3.8 < spread < 7.2
    assert 0.42 < heavy / (60 * 40) < 0.56  # half of the weight lies on a quarter of the rows
    each = relational.sample_n(df, "id", 7, per=["g"]).groupBy("g").count().collect()
    assert {r["count"] for r in each} == {7} and len(each) == 4
    # The sample of a union is the sample of the samples.
    parts = relational.sample_n(df.where("id < 150"), "id", 40).unionByName(relational.sample_n(df.where("id >= 150"), "id", 40))
    assert rows(relational.sample_n(parts, "id", 40), "id") == rows(relational.sample_n(df, "id", 40), "id")
    assert relational.sample_n(df.withColumn("w", F.lit(0.0)), "id", 5, weight="w").count() == 0


def test_reconcile_content(spark, tmp_path, capsys):
    schema = "day date, k string, v int"
    jan, feb = d("2020-01-01"), d("2020-02-01")
    data = [(jan, f"a{i}", i) for i in range(50)] + [(feb, f"b{i}", i) for i in range(50)] + [(None, "n", 1), (feb, None, 1), (jan, "twice", 1), (jan, "twice", 1)]
    source = spark.createDataFrame(data, schema)
    assert files.reconcile_content(source, source, "day", ["k"]).count() == 0
    other = [r for r in data if r[1] != "b7"] + [(feb, "b51", 1), (None, "n", 2)]
    other[51] = (feb, "b0", None) if other[51][1] == "b1" else other[51]
    other.remove((jan, "twice", 1))
    target = spark.createDataFrame(other, schema)
    got = {(r.day, r.k): r.state for r in files.reconcile_content(source, target, "day", ["k"]).collect()}
    want = {(feb, "b7"): "missing", (feb, "b51"): "extra", (None, "n"): "changed", (jan, "twice"): "changed"}
    if other[50][1] == "b0" and other[51] == (feb, "b0", None):
        want |= {(feb, "b0"): "changed", (feb, "b1"): "missing"}
    assert got == want
    # Equal days are not read again: the lower levels name the days that differ.
    path = str(tmp_path / "t")
    source.where("day is not null").write.partitionBy("day").parquet(path)
    changed = source.where("day is not null").withColumn("v", F.when(F.col("k") == "b3", 99).otherwise(F.col("v")))
    out = files.reconcile_content(spark.read.parquet(path).select("day", "k", "v"), changed, "day", ["k"])
    out.explain()
    plan = capsys.readouterr().out
    assert "2020-02-01" in plan and "2020-01-01" not in plan
    assert [(r.k, r.state) for r in out.collect()] == [("b3", "changed")]
