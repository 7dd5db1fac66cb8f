"""Registered queries: the operators, each over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewharf.functions import (
    by_threshold,
    day_of_week,
    flag,
    is_trading_day,
    is_weekend,
    moment,
    month_start,
    pad_code,
    roll,
    safe_ratio,
)
from tradewharf.operators import asof, calendars, generators, ordering, quality, relational, scd2
from tradewharf.operators.distinct import distinct_counts
from tradewharf.operators.hierarchy import chain_revenue, manager_chain
from tradewharf.operators.incremental import (
    append_columns,
    incremental,
    unloaded_late_rows,
    upsert_keyed,
    upsert_path,
)
from tradewharf.plans.checks import CONSTRAINTS, GOLD_CHECKS, SOURCE_FRESHNESS, UNIQUE_WHERE
from tradewharf.plans.dims import PROFILE_CHECKS
from tradewharf.plans.refresh import refresh
from tradewharf.schemas import EMPLOYEE_SCHEMA, LANDED_BY_STAGED, PRODUCTS
from tradewharf.session import materialize, work_path
from tradewharf.sources import files
from tradewharf.sources.driver_tables import TRADE_TABLES, DriverTables
from tradewharf.streaming import stream_land, stream_upsert

OPERATOR_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Cut between the two batches of the replay queries.
CUT = dt.date(1999, 1, 1)
LOADED_AT = dt.datetime(2030, 1, 1)
AS_OF = dt.datetime(2001, 8, 3, 12)


def query(fn: Callable[[DriverTables], DataFrame]):
    """Register ``fn`` under its own name (``q_`` marks names that operators already have)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = fn(DriverTables(spark, sf_dir))
        doubles = [f.name for f in out.schema.fields if f.dataType.typeName() == "double"]
        return out.withColumns({c: F.round(c, 6) for c in doubles}) if doubles else out

    OPERATOR_QUERIES[fn.__name__.removeprefix("q_")] = run
    return fn


# -- sources, sinks, ingestion ----------------------------------------------------------------


@query
def export_partition(t: DriverTables) -> DataFrame:
    """All orders exported by month in one job, read back with the partition value."""
    out = work_path(t.spark, "export")
    month = month_start(F.col("o_orderdate").cast("date"))
    files.export_partitions(t.read("orders"), "o_orderdate", out, part=month)
    back = t.spark.read.parquet(out)
    return back.select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(20,2)").alias("total"), "dt")


@query
def export_partition_rerun(t: DriverTables) -> DataFrame:
    """Every day exported, then all again, one day again, and an empty day: nothing doubles."""
    out = work_path(t.spark, "export")
    events = t.read("events").withColumn("event_date", F.col("ts").cast("date"))
    files.export_partitions(events, "event_date", out)
    files.export_partitions(events, "event_date", out)
    files.export_partitions(events, "event_date", out, day=dt.date(2024, 1, 5))
    files.export_partitions(events, "event_date", out, day=dt.date(1990, 1, 1))
    return t.spark.read.parquet(out).select("event_id", "user_id", "dt")


@query
def land_variant(t: DriverTables) -> DataFrame:
    raw = files.land_variant(t.read("orders"), moment(LOADED_AT))
    payload = {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "decimal(20,2)",
        "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
    }
    return files.flatten_variant(raw, payload).withColumn(
        "_file_name", F.element_at(F.split("_file_name", "/"), -1)
    )


@query
def stream_ingest(t: DriverTables) -> DataFrame:
    """Two arrivals of files, then a run with nothing new."""
    base = work_path(t.spark, "ingest")
    events = t.read("events")
    schema = events.schema

    def run() -> None:
        stream_land(
            t.spark, f"{base}/in", schema, f"{base}/out", f"{base}/ck", moment(LOADED_AT)
        ).awaitTermination()

    events.where("event_type <> 'purchase'").write.parquet(f"{base}/in")
    run()
    events.where("event_type = 'purchase'").write.mode("append").parquet(f"{base}/in")
    run()
    run()
    landed = t.spark.read.parquet(f"{base}/out")
    payload = {
        "event_id": "bigint", "user_id": "bigint", "event_type": "string",
        "value": "decimal(20,2)", "ts": "timestamp_ntz",
    }
    return files.flatten_variant(landed, payload).drop("_file_name")


@query
def backfill_idempotent(t: DriverTables) -> DataFrame:
    """A second load of everything takes only the files the ledger does not list."""
    orders = t.read("orders").withColumn(
        "_file_name", F.concat(F.lit("orders/dt="), F.date_format("o_orderdate", "yyyy-MM-01"), F.lit("/part-0000.parquet"))
    )
    first = orders.where(F.col("o_orderdate") < F.lit(CUT))
    ledger = first.select(F.col("_file_name").alias("file_name")).distinct()
    second = files.load_new_files(orders, ledger)
    return first.withColumn("load_no", F.lit(1)).unionByName(second.withColumn("load_no", F.lit(2))).select(
        "o_orderkey", "_file_name", "load_no"
    )


@query
def backfill_changed_files(t: DriverTables) -> DataFrame:
    """A second delivery of everything: new files, files with a corrected row, and files whose
    ledger entry is older than 64 days are loaded, all others are skipped."""
    orders = t.read("orders").select(
        "o_orderkey", "o_orderdate", F.col("o_totalprice").cast("decimal(20,2)").alias("total"),
        F.concat(F.lit("orders/dt="), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("_file_name"),
    )
    content = ["o_orderkey", "total"]
    first = orders.where(F.col("o_orderdate") < F.lit(CUT))
    age = F.when(F.col("file_name") < "orders/dt=1993", 100).otherwise(10)
    ledger = files.file_ledger(first, content, moment(LOADED_AT)).withColumn("loaded_at", F.expr("loaded_at") - F.make_dt_interval(days=age))
    fixed = F.when(F.col("o_orderkey") % 50 == 0, F.col("total") + 1).otherwise(F.col("total"))
    again = orders.withColumn("total", fixed.cast("decimal(20,2)"))
    second = files.load_new_files(again, ledger, columns=content, as_of=LOADED_AT)
    return first.withColumn("load_no", F.lit(1)).unionByName(second.withColumn("load_no", F.lit(2))).drop("o_orderdate")


@query
def parse_json_props(t: DriverTables) -> DataFrame:
    parsed = t.read("events").select("event_id", F.try_parse_json("props").alias("raw"))
    return parsed.select("event_id", F.try_variant_get("raw", "$.k", "int").alias("k"))


@query
def full_refresh_dim(t: DriverTables) -> DataFrame:
    path = work_path(t.spark, "full-refresh")
    files.full_refresh(t.broker(), path)
    return files.full_refresh(t.broker(), path).select("broker_code", "broker_name", "is_active")


@query
def lake_partitioned_write(t: DriverTables) -> DataFrame:
    lake = files.write_lake(t.read("events"), work_path(t.spark, "lake"), "events", "ts")
    return lake.select("event_id", F.col("value").cast("decimal(20,2)").alias("value"), "execution_date")


def _registry(t: DriverTables) -> DataFrame:
    path = work_path(t.spark, "registry")
    t.employee().write.json(path)
    return files.read_registry(t.spark, path, EMPLOYEE_SCHEMA)


@query
def hr_employees(t: DriverTables) -> DataFrame:
    return _registry(t)


@query
def hr_filter(t: DriverTables) -> DataFrame:
    people = files.filter_registry(_registry(t), status="ACTIVE", person_type="EMPLOYEE", branch_code=None)
    return people.select("id_number", "employee_code", "status", "person_type")


@query
def hr_lookup(t: DriverTables) -> DataFrame:
    return files.lookup_person(_registry(t), "09000000000001").select("id_number", "full_name", "status")


@query
def verify_landing_profile(t: DriverTables) -> DataFrame:
    lake = t.landed_lake()
    out = None
    for product, staged in TRADE_TABLES.items():
        raw = lake[LANDED_BY_STAGED[staged].raw]
        part = files.landing_profile(raw, "source_trade_id", "trade_date", "source_system", "%E_%").withColumn(
            "product_type", F.lit(product)
        )
        out = part if out is None else out.unionByName(part)
    return out


@query
def reconcile_counts(t: DriverTables) -> DataFrame:
    """Landed rows per day (corrections included) against staged rows."""
    spec = LANDED_BY_STAGED["stg_equity__equity_trade"]
    landed = files.flatten_variant(t.landed(spec.staged), {"trade_date": "date"})
    return files.reconcile_counts(landed, t.staged(spec.staged), "trade_date")


@query
def reconcile_content(t: DriverTables) -> DataFrame:
    """A copy of the trades with lost, changed, moved and invented rows against the trades."""
    source = t.lake()["fact_equity_trade"].select("source_system", "source_trade_id", "trade_id", "trade_date", "amount")
    k = F.col("trade_id")
    copied = source.where(k % 97 != 5).withColumns({
        "amount": F.when(k % 101 == 7, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(20,2)"),
        "trade_date": F.when(k % 103 == 9, F.date_add("trade_date", 1)).otherwise(F.col("trade_date")),
    })
    new = source.where(k % 107 == 11).withColumn("source_trade_id", F.concat(F.lit("NEW-"), "source_trade_id"))
    return files.reconcile_content(source, copied.unionByName(new), "trade_date", ["source_system", "source_trade_id"])


# -- projections, filters, predicates ---------------------------------------------------------


@query
def stg_customer_no_pii(t: DriverTables) -> DataFrame:
    staged = t.lake()["stg_common__customer"]
    assert "id_number" not in staged.columns
    return staged.select("customer_code", "customer_name", "phone", "email")


@query
def star_except(t: DriverTables) -> DataFrame:
    return t.landed_lake()["stg_equity__equity_trade"].drop("_loaded_at")


@query
def flatten_variant(t: DriverTables) -> DataFrame:
    spec = LANDED_BY_STAGED["stg_equity__margin_loan_daily"]
    return files.flatten_variant(t.landed(spec.staged), spec.payload)


@query
def quarantine_bad_casts(t: DriverTables) -> DataFrame:
    """Contract ids that arrive as text are set aside; the others are typed."""
    spec = LANDED_BY_STAGED["stg_derivatives__derivative_trade"]
    rows = t.staged(spec.staged).withColumn(
        "contract_id",
        F.when(F.col("trade_id") % 50 == 1, F.lit("VN30F")).otherwise(F.col("contract_id").cast("string")),
    )
    raw = materialize(
        files.land_variant(rows, moment(LOADED_AT), F.lit("derivative_trade/part-0000.parquet")), "landing"
    )
    good, bad = files.split_bad_casts(raw, spec.payload)
    kept = good.select("source_trade_id", "contract_id", F.lit("").alias("bad_fields"))
    return kept.unionByName(
        bad.select(
            F.variant_get("raw_data", "$.source_trade_id", "string").alias("source_trade_id"),
            F.lit(None).cast("bigint").alias("contract_id"),
            "bad_fields",
        )
    )


@query
def filter_current(t: DriverTables) -> DataFrame:
    return t.lake()["dim_customer_broker_history"].where("is_current")


@query
def filter_equality(t: DriverTables) -> DataFrame:
    prices = t.lake()["stg_common__market_index_price"]
    return prices.where(F.col("index_code") == "VNINDEX").select("price_date", "close_value")


@query
def flag_case(t: DriverTables) -> DataFrame:
    return t.lake()["fact_margin_loan_daily"].select(
        "product_type", "account_id", "loan_date",
        flag(F.col("call_margin_flag"), F.col("margin_ratio") < F.col("maintenance_margin_ratio")).alias(
            "needs_attention"
        ),
    )


@query
def latest_date_slice(t: DriverTables) -> DataFrame:
    return relational.latest_slice(t.lake()["fact_margin_loan_daily"], "loan_date")


@query
def pit_join(t: DriverTables) -> DataFrame:
    """Trades with the broker who held the customer on the trade date."""
    lake = t.lake()
    held = lake["dim_customer_broker_history"].select(
        F.col("customer_code").alias("_customer"), F.col("broker_code").alias("holder_code"),
        "valid_from", "valid_to",
    )
    joined = relational.pit_join(
        lake["int_all_trades"], held, [("customer_code", "_customer")], "trade_date"
    )
    return joined.select("product_type", "trade_id", "trade_date", "customer_code", "holder_code", "valid_from")


@query
def asof_join(t: DriverTables) -> DataFrame:
    """The rows of ``pit_join`` by merging trades and holdings in time."""
    lake = t.lake()
    held = lake["dim_customer_broker_history"].select(
        F.col("customer_code").alias("_customer"), F.col("broker_code").alias("holder_code"),
        "valid_from", "valid_to",
    )
    trades = lake["int_all_trades"].select("product_type", "trade_id", "trade_date", "customer_code")
    joined = asof.asof_join(trades, held, [("customer_code", "_customer")], "trade_date")
    return joined.select("product_type", "trade_id", "trade_date", "customer_code", "holder_code", "valid_from")


@query
def rate_lookup(t: DriverTables) -> DataFrame:
    lake = t.lake()
    out = relational.rate_lookup(lake["int_all_trades"], lake["dim_fee_schedule"])
    return out.select("product_type", "trade_id", "trade_date", "fee_rate", "commission_rate")


@query
def rate_lookup_tiered(t: DriverTables) -> DataFrame:
    """A rate for the broker's own tier beats the default; every trade keeps one row."""
    lake = t.lake()
    default = lake["dim_fee_schedule"]
    senior = default.withColumns(
        {"broker_tier": F.lit("SENIOR"), "commission_rate": (F.col("commission_rate") + F.lit("0.1").cast("decimal(9,6)")).cast("decimal(9,6)")}
    )
    tiers = lake["dim_broker"].select("broker_code", F.col("broker_subtype").alias("tier"))
    trades = lake["int_all_trades"].join(tiers, "broker_code")
    out = relational.rate_lookup(trades, default.unionByName(senior), tier_col="tier")
    return out.select("product_type", "trade_id", "tier", "commission_rate")


@query
def month_partition_counts(t: DriverTables) -> DataFrame:
    trades = t.lake()["int_all_trades"]
    return trades.groupBy("product_type", month_start(F.col("trade_date")).alias("trade_month")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


# -- joins --------------------------------------------------------------------------------------


@query
def join_inner(t: DriverTables) -> DataFrame:
    lake = t.lake()
    unit = lake["dim_broker"].select("broker_code", "department_name")
    return lake["int_all_trades"].join(unit, "broker_code").select(
        "product_type", "trade_id", "broker_code", "department_name"
    )


@query
def join_composite(t: DriverTables) -> DataFrame:
    lake = t.lake()
    owner = lake["dim_account"].select("product_type", "account_id", "customer_code")
    return lake["fact_account_balance_daily"].join(owner, ["product_type", "account_id"]).select(
        "product_type", "account_id", "balance_date", "customer_code"
    )


@query
def join_left(t: DriverTables) -> DataFrame:
    lake = t.lake()
    names = lake["dim_broker"].select(F.col("broker_code").alias("_b"), "broker_name")
    return lake["dim_customer"].join(names, F.col("current_broker_code") == F.col("_b"), "left").select(
        "customer_code", "current_broker_code", "broker_name"
    )


@query
def snapshot_grid(t: DriverTables) -> DataFrame:
    """Every account on every trading day covered by the events."""
    day = F.col("ts").cast("date")
    bounds = t.read("events").agg(F.min(day).alias("first"), F.date_add(F.max(day), 1).alias("past"))
    accounts = t.lake()["dim_account"].select("product_type", "account_id")
    return calendars.snapshot_grid(accounts, bounds, "first", "past", "snapshot_date")


@query
def mark_to_market(t: DriverTables) -> DataFrame:
    lake = t.lake()
    held = lake["stg_equity__position_daily"].drop("market_value")
    prices = lake["stg_equity__daily_price"].select(
        "security_id", F.col("price_date").alias("position_date"), "close_price"
    )
    return calendars.mark_to_market(
        held, prices, ["security_id", "position_date"], "close_price", "avg_cost_price"
    ).select("account_id", "security_id", "position_date", "close_price", "market_value")


@query
def price_calendar_join(t: DriverTables) -> DataFrame:
    """Each contract on each trading day of its life, with the settlement price if any."""
    lake = t.lake()
    days = calendars.on_each_trading_day(
        lake["dim_derivative_contract"].select("contract_id", "listing_date", "maturity_date"),
        "listing_date", "maturity_date", "price_date",
    )
    prices = lake["stg_derivatives__daily_settlement_price"].select(
        "contract_id", "price_date", "settlement_price"
    )
    return days.join(prices, ["contract_id", "price_date"], "left").select(
        "contract_id", "price_date", "settlement_price"
    )


@query
def share_of_total(t: DriverTables) -> DataFrame:
    positions = t.lake()["fact_position_daily"].select(
        "product_type", "account_id", "instrument_id", "position_date", "market_value"
    )
    return relational.share_of_total(
        positions, "market_value", ["account_id", "position_date"], "day_value", "share"
    )


@query
def window_total(t: DriverTables) -> DataFrame:
    positions = t.lake()["fact_position_daily"].select(
        "product_type", "account_id", "instrument_id", "position_date", "market_value"
    )
    return relational.window_total(
        positions, "market_value", ["position_date", "product_type", "instrument_id"], "firm_value"
    )


@query
def orphans_trade_broker(t: DriverTables) -> DataFrame:
    lake = t.lake()
    return relational.orphans(lake["int_all_trades"], lake["dim_broker"], "broker_code", "broker_code").select(
        "product_type", "trade_id", "broker_code"
    )


@query
def orphans_position_account(t: DriverTables) -> DataFrame:
    lake = t.lake()
    accounts = lake["stg_equity__account"]
    held = lake["stg_equity__position_daily"].select("account_id", "security_id", "position_date")
    return relational.orphans(held, accounts, "account_id", "account_id")


@query
def q_manager_chain(t: DriverTables) -> DataFrame:
    return manager_chain(t.employee())


@query
def manager_chain_revenue(t: DriverTables) -> DataFrame:
    """Fee revenue of everybody below each manager."""
    lake = t.lake()
    people = t.employee()
    ids = lake["dim_broker"].select("broker_code", "id_number")
    revenue = (
        lake["int_all_trades"].groupBy("broker_code").agg(F.sum("fee_amount").alias("fee"))
        .join(ids, "broker_code").select("id_number", "fee")
    )
    return chain_revenue(people, manager_chain(people), revenue, "id_number", "fee")


# -- aggregations ---------------------------------------------------------------------------------


@query
def agg_sum(t: DriverTables) -> DataFrame:
    return t.lake()["int_all_trades"].groupBy("product_type", F.year("trade_date").alias("trade_year")).agg(
        F.sum("amount").alias("amount"), F.sum("fee_amount").alias("fee_amount")
    )


@query
def agg_multi_distinct(t: DriverTables) -> DataFrame:
    rows = t.lake()["int_all_trades"].withColumn("month", month_start(F.col("trade_date")))
    counted = {"trades": "trade_id", "customers": "customer_code", "brokers": "broker_code"}
    return distinct_counts(rows, ["product_type", "month"], counted)


@query
def agg_cond_distinct(t: DriverTables) -> DataFrame:
    # One row per counted customer first, so that neither count is a distinct one.
    each = t.lake()["int_all_trades"].groupBy("broker_code", "customer_code").agg(
        F.max(F.col("amount") >= 250000).alias("big")
    )
    return each.groupBy("broker_code").agg(
        F.count("customer_code").alias("customers"),
        F.count_if(F.col("big") & F.col("customer_code").isNotNull()).alias("big_customers"),
    )


@query
def agg_cond_sum(t: DriverTables) -> DataFrame:
    zero = F.lit(0).cast("decimal(20,2)")
    side, amount = F.col("side"), F.col("amount")
    return t.lake()["fact_equity_trade"].groupBy("security_id").agg(
        F.sum(F.when(side == "BUY", amount).otherwise(zero)).alias("bought"),
        F.sum(F.when(side == "SELL", amount).otherwise(zero)).alias("sold"),
        F.sum(F.when(side == "BUY", amount).otherwise(-amount)).alias("net"),
    )


@query
def agg_flags(t: DriverTables) -> DataFrame:
    def uses(p: str):
        return F.max(F.when(F.col("product_type") == p, 1).otherwise(0))

    return t.lake()["int_all_trades"].groupBy("customer_code").agg(
        uses("EQUITY").alias("uses_equity"), uses("OEF").alias("uses_oef")
    )


@query
def agg_first_last_date(t: DriverTables) -> DataFrame:
    return t.lake()["int_all_trades"].groupBy("customer_code").agg(
        F.min("trade_date").alias("first_trade"), F.max("trade_date").alias("last_trade")
    )


@query
def agg_open_close(t: DriverTables) -> DataFrame:
    """First and last close per security and quarter."""
    day = F.col("price_date")
    return t.lake()["stg_equity__daily_price"].groupBy(
        "security_id", F.year(day).alias("year"), F.quarter(day).alias("quarter")
    ).agg(F.min_by("close_price", "price_date").alias("open"), F.max_by("close_price", "price_date").alias("close"))


@query
def agg_ratio(t: DriverTables) -> DataFrame:
    """Fee per amount; customers without any amount get NULL."""
    return t.lake()["int_all_trades"].groupBy("product_type", "broker_code").agg(
        safe_ratio(F.sum("fee_amount"), F.sum("amount")).alias("fee_share"),
        safe_ratio(F.sum("amount"), F.sum(F.lit(0))).alias("no_divisor"),
    )


@query
def select_distinct(t: DriverTables) -> DataFrame:
    return t.lake()["int_all_trades"].select("account_no", "customer_code", "broker_code").distinct()


# -- windows, order, limits -------------------------------------------------------------------------


@query
def dedup_latest(t: DriverTables) -> DataFrame:
    """Latest shipped version of each order line; every column takes part in the tie-break."""
    rest = ["l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    out = relational.dedup_latest(t.read("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"], rest)
    return out.withColumns({c: F.col(c).cast("decimal(20,2)") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")})


def _weights(t: DriverTables) -> DataFrame:
    c = t.lake()["dim_customer"]
    return c.select("customer_code", generators.segment_weight(F.col("current_segment"), 8, 3).alias("weight"))


@query
def cumulative_ranges(t: DriverTables) -> DataFrame:
    return ordering.cumulative_ranges(_weights(t), "weight", "customer_code")


@query
def weighted_allocation(t: DriverTables) -> DataFrame:
    """Each customer drawn to a broker, brokers weighted 1 to 15."""
    brokers = t.read("supplier").select(
        pad_code("MG", F.col("s_suppkey"), 10).alias("broker_code"), (F.col("s_suppkey") % 15 + 1).alias("weight")
    )
    ranges = materialize(ordering.cumulative_ranges(brokers, "weight", "broker_code"), "ranges")
    total = ranges.agg(F.max("range_end").alias("w")).first()["w"]
    draws = t.read("customer").select(
        pad_code("KH", F.col("c_custkey"), 10).alias("customer_code"),
        (F.pmod(F.col("c_custkey") * 7919 + 11, F.lit(total)) + 1).alias("draw"),
    )
    return ordering.weighted_allocation(draws, ranges, "draw").select("customer_code", "draw", "broker_code")


@query
def top_n_per_row(t: DriverTables) -> DataFrame:
    """Three to eight securities for every equity account."""
    lake = t.lake()
    accounts = lake["stg_equity__account"].select("account_id", (F.col("account_id") % 6 + 3).alias("n"))
    securities = lake["dim_security"].select("security_id")
    out = ordering.top_n_per_row(accounts, securities, "n", "account_id", "security_id")
    return out.select("account_id", "security_id", "pick")


@query
def trading_day_ordinal(t: DriverTables) -> DataFrame:
    """Ordinal of each trading day in its month."""
    from pyspark.sql import Window

    days = calendars.trading_days(t.calendar_bounds(), "start_date", "end_date")
    day = F.col("trading_day")
    w = Window.partitionBy(month_start(day)).orderBy(day)
    return days.withColumn("rn", F.row_number().over(w))


@query
def weight_by_rank(t: DriverTables) -> DataFrame:
    securities = t.lake()["dim_security"].select("security_id", "sector")
    return generators.weight_by_rank(securities, "sector", "security_id", 6, 15)


@query
def front_month_weights(t: DriverTables) -> DataFrame:
    contracts = t.lake()["dim_derivative_contract"].select("contract_id", "maturity_date")
    return generators.front_month_weights(contracts, F.lit(dt.date(1998, 1, 1)))


@query
def number_spine(t: DriverTables) -> DataFrame:
    """Numbers 1..count(orders) with how many orders carry each as key: gaps show as 0."""
    orders = t.read("orders")
    counts = orders.groupBy(F.col("o_orderkey").alias("n")).agg(F.count(F.lit(1)).alias("c"))
    spine = calendars.number_spine(t.spark, orders.count())
    return spine.join(counts, "n", "left").select("n", F.coalesce("c", F.lit(0)).alias("order_count"))


@query
def open_accounts(t: DriverTables) -> DataFrame:
    """Customers other than the firm itself who have a current broker."""
    lake = t.lake()
    current = lake["dim_customer_broker_history"].where("is_current").select("customer_code", "broker_code")
    return lake["stg_common__customer"].where(F.col("customer_type") != "PROPRIETARY").join(
        current, "customer_code"
    ).select("customer_code", "broker_code", "open_date")


@query
def account_numbering(t: DriverTables) -> DataFrame:
    customers = t.lake()["stg_common__customer"].where(F.col("customer_type") != "PROPRIETARY")
    return generators.numbered_accounts(customers.select("customer_code"), "customer_code", "0001", 6)


@query
def base_price(t: DriverTables) -> DataFrame:
    securities = t.lake()["dim_security"].select("security_id", "sector")
    sectors = t.read("part").groupBy(F.col("p_type").alias("sector")).agg(
        F.min("p_size").alias("price_min"), F.max("p_size").alias("price_max")
    )
    return generators.base_price(securities, sectors).select("security_id", "sector", "base_price")


@query
def top_k(t: DriverTables) -> DataFrame:
    trades = t.lake()["int_all_trades"].select("product_type", "trade_id", "amount")
    return relational.top_k(trades, 100, F.desc("amount"), F.asc("product_type"), F.asc("trade_id"))


@query
def sample_n(t: DriverTables) -> DataFrame:
    customers = t.read("customer").select("c_custkey")
    return relational.sample_n(customers, "c_custkey", 800)


@query
def sample_per_nation(t: DriverTables) -> DataFrame:
    """Five customers of each nation, drawn without replacement."""
    customers = t.read("customer").select("c_custkey", "c_nationkey")
    return relational.sample_n(customers, "c_custkey", 5, per=["c_nationkey"])


@query
def first_by_key(t: DriverTables) -> DataFrame:
    """First broker by code of each subtype."""
    return t.lake()["dim_broker"].groupBy("broker_subtype").agg(F.min("broker_code").alias("first_broker"))


@query
def ensure_class_present(t: DriverTables) -> DataFrame:
    """A class that exists changes nothing; a missing one promotes the first broker."""
    brokers = t.lake()["dim_broker"].select("broker_code", "broker_type", "broker_subtype")
    eligible = F.col("broker_type") == "BROKER"
    present = relational.ensure_class_present(brokers, "broker_subtype", "STANDARD", eligible, "broker_code")
    missing = relational.ensure_class_present(
        present.withColumn("promoted", F.col("broker_subtype")), "promoted", "DESK_HEAD", eligible, "broker_code"
    )
    return missing.select("broker_code", "broker_subtype", "promoted")


@query
def history_timeline(t: DriverTables) -> DataFrame:
    """Version number of every assignment in its customer's history."""
    history = t.lake()["dim_customer_broker_history"].select("customer_code", "broker_code", "valid_from")
    return ordering.bucketed_row_number(
        history, ["customer_code"], "valid_from", F.year("valid_from"), "version_no"
    )


@query
def union_all(t: DriverTables) -> DataFrame:
    lake = t.lake()
    frames = {p: lake[s] for p, s in TRADE_TABLES.items()}
    return relational.union_tagged(frames, "product_type", ["source_trade_id", "amount"])


@query
def scalar_functions(t: DriverTables) -> DataFrame:
    """Calendar, text and arithmetic functions on every order."""
    day = F.col("o_orderdate").cast("date")
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(20,2)")
    return t.read("orders").select(
        "o_orderkey",
        F.year(day).alias("y"), F.quarter(day).alias("q"), F.month(day).alias("m"),
        F.monthname(day).alias("month_name"), F.dayname(day).alias("day_name"),
        F.weekofyear(day).alias("week"), day_of_week(day).alias("dow"), is_weekend(day).alias("weekend"),
        is_trading_day(day).alias("trading_day"),
        F.date_add(day, -90).alias("minus_90"), F.add_months(day, 1).alias("plus_month"),
        F.last_day(day).alias("month_end"), month_start(day).alias("month_first"),
        F.datediff(F.lit(dt.date(2002, 1, 1)), day).alias("days_left"),
        F.date_format(day, "yyyyMM").alias("yyyymm"), F.date_format(day, "yyMM").alias("yymm"),
        F.make_date(F.year(day), F.month(day), F.lit(1)).alias("from_parts"),
        pad_code("KH", k, 10).alias("code"), F.chr(F.lit(64) + k % 26 + 1).alias("letter"),
        F.upper(F.trim(F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")))).alias("upper_trim"),
        F.coalesce(F.nullif(k % 3, F.lit(0)), F.lit(-1)).alias("nullif_coalesce"),
        F.round(price * F.lit("0.0015").cast("decimal(9,4)"), 2).cast("decimal(20,2)").alias("rounded"),
        safe_ratio(price, k % 5).alias("ratio"),
        F.expr("try_cast(o_orderpriority as int)").alias("bad_cast"),
        (F.col("o_orderdate") + F.expr("make_dt_interval(0, 9, 30, 0)")).alias("opening"),
    )


# -- spines and generators ------------------------------------------------------------------------------


@query
def trading_calendar(t: DriverTables) -> DataFrame:
    return calendars.trading_days(t.calendar_bounds(), "start_date", "end_date")


@query
def trading_days_of_month(t: DriverTables) -> DataFrame:
    """Trading days of the last month with orders, as a half-open window."""
    last = t.read("orders").agg(month_start(F.max("o_orderdate").cast("date")).alias("first"))
    bounds = last.select("first", F.add_months("first", 1).alias("past"))
    return calendars.trading_days(bounds, "first", "past")


@query
def threshold_bucket(t: DriverTables) -> DataFrame:
    draw = roll(F.col("o_orderkey"), 31, 17)
    return t.read("orders").select(
        "o_orderkey", draw.alias("draw"),
        by_threshold(draw, [(55, "SUBSCRIBE"), (95, "REDEEM")], "SWITCH").alias("transaction_type"),
        by_threshold(draw, [(50, "LOW"), (85, "MEDIUM")], "HIGH").alias("risk_level"),
        by_threshold(draw, [(80, "RETAIL"), (95, "PRIORITY")], "VIP").alias("segment"),
    )


@query
def trade_enrichment(t: DriverTables) -> DataFrame:
    """Line items enriched as trades of the product their part belongs to."""
    p = F.col("l_partkey")
    base = t.read("lineitem").select(
        "l_orderkey", "l_linenumber", p.alias("instrument_id"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
        F.col("l_quantity").cast("decimal(18,0)").alias("quantity"),
        (p % 90 + 10).cast("decimal(18,2)").alias("price"),
        F.when(F.col("l_linestatus") == "O", "BUY").otherwise("SELL").alias("side"),
        F.lit(100).cast("decimal(18,2)").alias("multiplier"),
        F.col("l_extendedprice").cast("decimal(20,2)").alias("value"),
    )
    columns = ["l_orderkey", "l_linenumber", "instrument_id", "amount", "fee_amount", "extra", "settlement_date"]
    equity = generators.enrich_trades(base.where("instrument_id % 10 < 8"), "EQUITY")
    derivatives = generators.enrich_trades(base.where("instrument_id % 10 = 8"), "DERIVATIVES")
    funds = generators.enrich_trades(
        base.where("instrument_id % 10 = 9").withColumns(
            {"amount": F.col("value"), "nav_price": (F.col("instrument_id") % 900 + 100).cast("decimal(18,4)")}
        ),
        "OEF",
    )
    wide = "decimal(20,4)"
    return relational.union_tagged(
        {
            "EQUITY": equity.withColumn("extra", F.col("tax_amount").cast(wide)),
            "DERIVATIVES": derivatives.withColumn("extra", F.col("margin_amount").cast(wide)),
            "OEF": funds.withColumn("extra", F.col("quantity_unit").cast(wide)),
        },
        "product_type",
        columns,
    )


@query
def margin_flags(t: DriverTables) -> DataFrame:
    loans = t.lake()["fact_margin_loan_daily"].select("product_type", "account_id", "loan_date", "margin_ratio")
    return generators.margin_flags(loans)


@query
def contract_calendar(t: DriverTables) -> DataFrame:
    return generators.contract_calendar(t.calendar_bounds(), "start_date", "end_date", "VN30F")


@query
def price_bands(t: DriverTables) -> DataFrame:
    prices = t.lake()["stg_equity__daily_price"].select("price_date", "security_id", "reference_price")
    return generators.price_bands(prices)


# -- incremental, history, streams ------------------------------------------------------------------------

_KEYS = ["source_system", "source_trade_id"]


def _trades_twice(t: DriverTables) -> tuple[DataFrame, DataFrame]:
    """First load: trades before the cut, written out. Second delivery: all trades, one in
    fifty with a corrected amount."""
    rows = t.lake()["fact_equity_trade"].select(*_KEYS, "trade_id", "trade_date", "amount", "ingested_at")
    first = materialize(rows.where(F.col("trade_date") < F.lit(CUT)), "first-load")
    fixed = F.when(F.col("trade_id") % 50 == 0, F.col("amount") + 1).otherwise(F.col("amount"))
    return first, rows.withColumn("amount", fixed.cast("decimal(20,2)"))


@query
def incremental_watermark(t: DriverTables) -> DataFrame:
    first, second = _trades_twice(t)
    fresh, _ = incremental(second, first, "ingested_at")
    return upsert_keyed(first, fresh, _KEYS).select("source_trade_id", "trade_date", "amount")


@query
def late_rows(t: DriverTables) -> DataFrame:
    """Corrections at or below the watermark: what the strict run does not load."""
    first, second = _trades_twice(t)
    _, late = incremental(second, first, "ingested_at")
    return unloaded_late_rows(late, first, [*_KEYS, "amount"]).select("source_trade_id", "trade_date", "amount")


@query
def incremental_per_branch(t: DriverTables) -> DataFrame:
    """Balances loaded up to a different day per product, then one increment."""
    rows = t.lake()["fact_account_balance_daily"].select("product_type", "account_id", "balance_date", "cash_balance")
    until = {"EQUITY": dt.date(2024, 1, 15), "DERIVATIVES": dt.date(2024, 1, 10)}
    loaded = F.lit(False)
    for p, d in until.items():
        loaded = loaded | ((F.col("product_type") == p) & (F.col("balance_date") < F.lit(d)))
    first = materialize(rows.where(loaded), "first-load")
    second = rows.withColumn("cash_balance", (F.col("cash_balance") + 1).cast("decimal(20,2)"))
    fresh, _ = incremental(second, first, "balance_date", per="product_type", branches=PRODUCTS)
    return upsert_keyed(first, fresh, ["product_type", "account_id", "balance_date"])


@query
def q_upsert_keyed(t: DriverTables) -> DataFrame:
    """Month-partitioned upsert with corrections that move to another month, applied twice."""
    rows = t.lake()["fact_equity_trade"].select(*_KEYS, "trade_id", "trade_date", "amount")

    def monthly(df: DataFrame) -> DataFrame:
        return df.withColumn("trade_month", month_start(F.col("trade_date")))

    path = work_path(t.spark, "upsert")
    before = F.col("trade_date") < F.lit(CUT)
    upsert_path(t.spark, path, monthly(rows.where(before)), _KEYS, "trade_month")
    hit = F.col("trade_id") % 50 == 0
    batch = monthly(
        rows.where(~before | hit).withColumns(
            {
                "trade_date": F.when(hit, F.date_add("trade_date", 40)).otherwise(F.col("trade_date")),
                "amount": F.when(hit, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(20,2)"),
            }
        )
    )
    upsert_path(t.spark, path, batch, _KEYS, "trade_month")
    out = upsert_path(t.spark, path, batch, _KEYS, "trade_month")
    return out.select("source_trade_id", "trade_date", "amount", "trade_month")


@query
def schema_append(t: DriverTables) -> DataFrame:
    """A column that appears with the second batch is NULL for the first."""
    rows = t.lake()["fact_equity_trade"].select("source_trade_id", "trade_date", "amount", "market")
    first = rows.where(F.col("trade_date") < F.lit(CUT)).drop("market")
    return append_columns(first, rows.where(F.col("trade_date") >= F.lit(CUT)))


#: Run times of the three captured states.
RUNS = [dt.datetime(2002, 1, d) for d in (1, 2, 3)]


def profile_states(t: DriverTables) -> list[DataFrame]:
    """Three states of the customer dimension: changes, a revert, NULL to value, changes
    outside the checked columns, vanished and new customers."""
    base = t.lake()["dim_customer"].withColumn("_k", F.substring("customer_code", 3, 20).cast("bigint") % 10)
    k = F.col("_k")

    def state(broker, active, name, present) -> DataFrame:
        return base.where(present).withColumns(
            {
                "current_broker_code": F.when(broker, F.lit("MG-CHANGED")).otherwise(F.col("current_broker_code")),
                "is_active": F.when(active, ~F.col("is_active")).otherwise(F.col("is_active")),
                "customer_name": F.when(name, F.lit("renamed")).otherwise(F.col("customer_name")),
                "current_segment": F.when(F.lit(len(out) == 0) & (k == 6), F.lit(None)).otherwise(F.col("current_segment")),
            }
        ).drop("_k")

    out: list[DataFrame] = []
    never = F.lit(False)
    out.append(state(never, never, never, k != 4))
    out.append(state(k == 1, k == 2, k == 5, k != 3))
    out.append(state(never, k == 2, k == 5, F.lit(True)))
    return out


def captured_profile(t: DriverTables) -> DataFrame:
    history = None
    for state, at in zip(profile_states(t), RUNS):
        history = materialize(
            scd2.snapshot_check(state, history, "customer_code", PROFILE_CHECKS, moment(at)),
            "snapshot",
        )
    return history


@query
def scd2_snapshot(t: DriverTables) -> DataFrame:
    return captured_profile(t).select(
        "customer_code", "customer_name", "current_broker_code", "current_segment", "is_active",
        "valid_from", "valid_to", "version_id",
    )


@query
def dim_customer_history(t: DriverTables) -> DataFrame:
    lake = t.lake().with_tables(snap_customer_profile=captured_profile(t))
    return lake["dim_customer_history"]


@query
def profile_as_of(t: DriverTables) -> DataFrame:
    """Complete customer profile at one moment, from the captured history."""
    at = moment(dt.datetime(2002, 1, 2, 12))
    history = captured_profile(t)
    return history.where(
        (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))
    ).select("customer_code", "current_broker_code", "current_segment", "is_active")


@query
def history_as_of(t: DriverTables) -> DataFrame:
    return scd2.scd2_as_of(t.lake()["dim_customer_broker_history"], F.lit(dt.date(1998, 6, 30)))


def _broker_changes(t: DriverTables) -> DataFrame:
    """Changes for every customer: one in 2010, a second in 2020 for odd keys, one too early
    for every fifth and a second on the same day for every fourth."""
    def change(seq: int, day: str, broker: str, when: str) -> str:
        return (
            f"case when {when} then named_struct('seq', {seq}, 'effective_date', {day}, "
            f"'broker_code', '{broker}') end"
        )

    rows = ", ".join(
        [
            change(1, "date_add(date'2010-01-01', cast(c_custkey % 100 as int))", "MG-A", "true"),
            change(2, "date'2020-06-01'", "MG-B", "c_custkey % 2 = 1"),
            change(3, "date'1990-01-01'", "MG-C", "c_custkey % 5 = 0"),
            change(4, "date_add(date'2010-01-01', cast(c_custkey % 100 as int))", "MG-D", "c_custkey % 4 = 0"),
        ]
    )
    return t.pick(
        "customer",
        "concat('KH', lpad(cast(c_custkey as string), greatest(10, length(cast(c_custkey as string))), '0')) as customer_code",
        f"inline(filter(array({rows}), x -> x is not null))",
    )


@query
def scd2_apply_changes(t: DriverTables) -> DataFrame:
    history = t.lake()["dim_customer_broker_history"]
    return scd2.scd2_apply(history, _broker_changes(t), "customer_code", ["broker_code"], "effective_date")


@query
def scd2_rejected_changes(t: DriverTables) -> DataFrame:
    history = t.lake()["dim_customer_broker_history"]
    return scd2.scd2_rejected(history, _broker_changes(t), "customer_code", "effective_date")


def _customer_changes(t: DriverTables, fields: str, late: str, first: str, second: str) -> DataFrame:
    """A change per customer in 2010, a second one for odd keys, and one that is too early for
    every fifth; each sets all ``fields``."""
    def change(seq: int, day: str, values: str, when: str) -> str:
        named = ", ".join(f"'{f}', '{v}'" for f, v in zip(fields.split(), values.split()))
        return f"case when {when} then named_struct('seq', {seq}, 'effective_date', {day}, {named}) end"

    rows = ", ".join([
        change(1, "date_add(date'2010-01-01', cast(c_custkey % 100 as int))", first, "true"),
        change(2, "date'2020-06-01'", second, "c_custkey % 2 = 1"),
        change(3, "date'1990-01-01'", late, "c_custkey % 5 = 0"),
    ])
    return t.pick(
        "customer",
        "concat('KH', lpad(cast(c_custkey as string), greatest(10, length(cast(c_custkey as string))), '0')) as customer_code",
        f"inline(filter(array({rows}), x -> x is not null))",
    )


@query
def scd2_risk_changes(t: DriverTables) -> DataFrame:
    """Classification and risk level change together: one version holds both."""
    fields = "investor_classification risk_level"
    changes = _customer_changes(t, fields, "PROFESSIONAL LOW", "PROFESSIONAL HIGH", "NON_PROFESSIONAL MEDIUM")
    return scd2.scd2_apply(t.lake()["stg_common__customer_risk_profile"], changes, "customer_code", fields.split(), "effective_date")


@query
def scd2_segment_changes(t: DriverTables) -> DataFrame:
    changes = _customer_changes(t, "segment", "RETAIL", "PRIORITY", "VIP")
    return scd2.scd2_apply(t.lake()["stg_common__customer_segment_history"], changes, "customer_code", ["segment"], "effective_date")


@query
def scd2_audit(t: DriverTables) -> DataFrame:
    """Audit of a history that got overlapping and gapped rows on top."""
    history = t.lake()["dim_customer_broker_history"].select("customer_code", "valid_from", "valid_to", "is_current")
    extra = t.pick(
        "customer",
        "concat('KH', lpad(cast(c_custkey as string), greatest(10, length(cast(c_custkey as string))), '0')) as customer_code",
        "case when c_custkey % 2 = 0 then date'1996-05-01' else date'1990-01-01' end as valid_from",
        "case when c_custkey % 3 = 0 then date'1990-06-30' else date'1996-12-31' end as valid_to",
        "c_custkey % 7 = 0 as is_current",
    )
    return scd2.scd2_audit(history.unionByName(extra), "customer_code")


@query
def q_stream_upsert(t: DriverTables) -> DataFrame:
    """Landing in two arrivals, corrections second; each arrival upserted by the stream."""
    base = work_path(t.spark, "stream-upsert")
    spec = LANDED_BY_STAGED["stg_equity__equity_trade"]

    def run() -> None:
        stream_upsert(
            t.spark, f"{base}/in", spec, "trade_date", f"{base}/out", f"{base}/ck"
        ).awaitTermination()

    files.land_variant(t.staged(spec.staged), moment(LOADED_AT), F.lit("a.parquet")).write.parquet(f"{base}/in")
    run()
    later = moment(LOADED_AT + dt.timedelta(days=1))
    files.land_variant(t.corrected(spec.staged), later, F.lit("b.parquet")).write.mode("append").parquet(f"{base}/in")
    run()
    return t.spark.read.parquet(f"{base}/out").select("source_trade_id", "trade_date", "amount", "_loaded_at")


@query
def refresh_job(t: DriverTables) -> DataFrame:
    """The whole refresh into a new folder, with its quality report."""
    return refresh(t.spark, t.sources(), work_path(t.spark, "refresh"), RUNS[0], strict=False)


# -- quality --------------------------------------------------------------------------------------------------


def _checked(t: DriverTables, checks, as_of: dt.datetime = AS_OF, run=quality.run_checks) -> DataFrame:
    lake = t.lake(as_of.date())
    names = {c.table for c in checks} | {c.parent for c in checks if c.parent}
    return run({n: lake[n] for n in names}, list(checks), as_of)


def _of_kind(kind: str):
    return [c for c in GOLD_CHECKS if c.kind == kind]


@query
def dq_missing(t: DriverTables) -> DataFrame:
    return _checked(t, [*_of_kind("missing"), quality.Check("fact_equity_trade", "missing", ("customer_code",))])


@query
def dq_duplicates(t: DriverTables) -> DataFrame:
    return _checked(t, [c for c in _of_kind("duplicates") if len(c.columns) == 1] + [
        quality.Check("dim_account", "duplicates", ("account_id",))
    ])


@query
def dq_unique_combo(t: DriverTables) -> DataFrame:
    return _checked(t, [c for c in _of_kind("duplicates") if len(c.columns) > 1] + [
        quality.Check("int_all_trades", "duplicates", ("product_type", "customer_code"))
    ])


@query
def dq_accepted_values(t: DriverTables) -> DataFrame:
    return _checked(t, [*_of_kind("accepted_values"), quality.Check("fact_oef_trade", "accepted_values", ("transaction_type",), values=("SUBSCRIBE",), name="subscribe_only")])


@query
def dq_orphans(t: DriverTables) -> DataFrame:
    return _checked(t, [*_of_kind("orphans"), quality.Check("int_all_trades", "orphans", ("broker_code",), parent="dim_broker", parent_key="broker_code")])


@query
def dq_row_count(t: DriverTables) -> DataFrame:
    return _checked(t, _of_kind("row_count"))


@query
def dq_non_negative(t: DriverTables) -> DataFrame:
    return _checked(t, _of_kind("non_negative"))


@query
def dq_freshness(t: DriverTables) -> DataFrame:
    return _checked(t, _of_kind("freshness"))


@query
def dq_source_freshness(t: DriverTables) -> DataFrame:
    return _checked(t, SOURCE_FRESHNESS, dt.datetime(2024, 2, 1, 6))


@query
def dq_rate_overlap(t: DriverTables) -> DataFrame:
    """Rates that could match one trade twice: none in the schedule itself, every one that
    was prolonged by a day."""
    rates = t.lake()["dim_fee_schedule"].select(
        "fee_schedule_id", "product_type", "broker_tier", "effective_from", "effective_to"
    )
    longer = rates.withColumn("effective_to", F.date_add("effective_to", 1))
    keys = ["product_type", "broker_tier"]
    clean = scd2.overlapping_periods(rates, keys, "effective_from", "effective_to")
    hit = scd2.overlapping_periods(longer, keys, "effective_from", "effective_to")
    return clean.withColumn("source", F.lit("schedule")).unionByName(
        hit.withColumn("source", F.lit("prolonged"))
    ).select("source", "fee_schedule_id", "effective_to", "next_from")


@query
def dq_rowcount_anomaly(t: DriverTables) -> DataFrame:
    lake = t.lake()
    out = None
    for name in ("fact_equity_trade", "fact_derivative_trade", "fact_oef_trade"):
        part = quality.rowcount_anomalies(lake[name], "trade_date").withColumn("table_name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query
def dq_check_constraints(t: DriverTables) -> DataFrame:
    return _checked(t, CONSTRAINTS)


@query
def dq_unique_where(t: DriverTables) -> DataFrame:
    return _checked(t, UNIQUE_WHERE)


@query
def dq_report(t: DriverTables) -> DataFrame:
    """All gold checks."""
    return _checked(t, GOLD_CHECKS, run=quality.write_checks)
