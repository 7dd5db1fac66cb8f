"""The thirteen business reports and their documented variants.

Facts are reduced to the report's grain before they meet a dimension wherever the result
allows it: the joins then handle groups instead of trades, and a hot broker or customer has
been combined map-side before anything is exchanged.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewharf.functions import flag, safe_ratio, struct_rows
from tradewharf.operators.distinct import BITS, WORD, count_nested, count_values, count_words, id_words, merge_words, side_by_side
from tradewharf.operators.relational import latest_slice, pit_join, rate_lookup, window_total
from tradewharf.registry import model

LAYER = "MARTS"
DORMANT_DAYS = 90
INDEX_CODE = "VNINDEX"


def _report(name: str, deps: list[str], **options):
    return model(name, LAYER, deps, materialized="view", **options)


def _day(as_of: dt.date | None):
    return F.current_date() if as_of is None else F.lit(as_of)


@_report("rpt_broker_commission_revenue", ["int_all_trades", "dim_broker", "dim_fee_schedule"])
def broker_commission_revenue(trades: DataFrame, brokers: DataFrame, rates: DataFrame) -> DataFrame:
    """Trade count, turnover, fee revenue and broker commission per day, product, broker.

    The rate depends on product and date only, both group keys, so trades are summed first
    and the rate meets one row per group. Overlapping rates repeat a group's sums exactly as
    they would repeat its trades.
    """
    per_day = trades.groupBy("trade_date", "product_type", "broker_code").agg(
        F.count_distinct("trade_id").alias("trade_count"),
        F.sum("amount").alias("trade_amount"),
        F.sum("fee_amount").alias("fee_revenue"),
    )
    unit = brokers.select(
        "broker_code", "broker_name", "department_id", "department_name", "branch_id", "branch_name"
    )
    rated = rate_lookup(per_day.join(unit, "broker_code"), rates, days_from=trades)
    return rated.groupBy(
        "trade_date", "product_type", "broker_code", "broker_name", "department_id",
        "department_name", "branch_id", "branch_name",
    ).agg(
        F.max("trade_count").alias("trade_count"),
        F.sum("trade_amount").alias("trade_amount"),
        F.sum("fee_revenue").alias("fee_revenue"),
        F.sum(F.col("fee_revenue") * F.col("commission_rate")).alias("broker_commission_amount"),
    )


@_report("rpt_department_branch_ranking", ["int_all_trades", "dim_broker"])
def department_branch_ranking(trades: DataFrame, brokers: DataFrame) -> DataFrame:
    """Trades, customers, turnover and fees per month, unit and product.

    Trades become sets of ids per month and broker, customers one row per month and broker they
    dealt with; only these meet the brokers. The two counts are separate aggregates.
    """
    unit = brokers.select(
        "broker_code", "branch_id", "branch_name", "department_id", "department_name"
    )
    own = ["trade_year", "trade_month", "product_type", "broker_code"]
    by = [
        "trade_year", "trade_month", "branch_id", "branch_name", "department_id", "department_name", "product_type",
    ]
    dated = trades.withColumns({"trade_year": F.year("trade_date"), "trade_month": F.month("trade_date")})
    money = ["trade_amount", "fee_revenue"]
    words = id_words(dated, own, "trade_id", {"trade_amount": F.col("amount"), "fee_revenue": F.col("fee_amount")})
    customers = dated.select(*own, "customer_code").distinct()
    return side_by_side(
        [
            count_words(words.join(unit, "broker_code"), by, "trade_count", money),
            count_values(customers.join(unit, "broker_code"), by, "customer_code", "active_customer_count"),
        ],
        by,
    ).select(*by, "trade_count", "active_customer_count", *money)


@_report("department_rank", ["rpt_department_branch_ranking"])
def department_rank(ranking: DataFrame) -> DataFrame:
    """Rank of each department by monthly turnover over all products.

    The window runs over departments of one month, after the trades have been summed.
    """
    monthly = ranking.groupBy(
        "trade_year", "trade_month", "department_id", "department_name"
    ).agg(F.sum("trade_amount").alias("trade_amount"))
    w = Window.partitionBy("trade_year", "trade_month").orderBy(F.desc("trade_amount"))
    return monthly.withColumn("turnover_rank", F.dense_rank().over(w))


@_report(
    "rpt_broker_performance",
    ["dim_broker", "dim_customer_broker_history", "int_all_trades"],
    uses_as_of=True,
)
def broker_performance(
    brokers: DataFrame, history: DataFrame, trades: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """Managed and trading customers, retention over the last 90 days, turnover per broker.

    Distinct customers are counted by grouping on (broker, customer) first, which also
    spreads a hot broker; the second grouping sees one row per pair.
    """
    cutoff = F.date_add(_day(as_of), -DORMANT_DAYS)
    managed = (
        history.where("is_current").select("broker_code", "customer_code").distinct()
        .groupBy("broker_code").agg(F.count("customer_code").alias("_managed"))
    )
    activity = (
        trades.groupBy("broker_code", "customer_code")
        .agg(
            F.max("trade_date").alias("_last"),
            F.sum("amount").alias("_amount"),
            F.sum("fee_amount").alias("_fee"),
        )
        .groupBy("broker_code")
        .agg(
            F.count("customer_code").alias("_trading"),
            F.count(F.when(F.col("_last") >= cutoff, F.col("customer_code"))).alias("_active"),
            F.sum("_amount").alias("_amount"),
            F.sum("_fee").alias("_fee"),
        )
    )
    zero = F.lit(0).cast("decimal(38,2)")
    return (
        brokers.join(managed, "broker_code", "left")
        .join(activity, "broker_code", "left")
        .select(
            "broker_code", "broker_name", "broker_type", "department_name", "branch_name",
            F.coalesce("_managed", F.lit(0)).alias("managed_customer_count"),
            F.coalesce("_trading", F.lit(0)).alias("trading_customer_count"),
            F.coalesce("_active", F.lit(0)).alias("active_last_90d_customer_count"),
            safe_ratio(F.col("_active"), F.col("_managed")).alias("retention_ratio_90d"),
            F.coalesce(F.col("_amount").cast("decimal(38,2)"), zero).alias("total_trade_amount"),
            F.coalesce(F.col("_fee").cast("decimal(38,2)"), zero).alias("total_fee_revenue"),
            safe_ratio(F.col("_fee"), F.col("_managed")).alias("fee_revenue_per_customer"),
        )
    )


@_report("rpt_trading_activity_summary", ["int_all_trades", "dim_customer"])
def trading_activity_summary(trades: DataFrame, customers: DataFrame) -> DataFrame:
    """Trades, trading days, turnover and average per customer, product and month.

    A month has at most 31 days, so its distinct trade days are the set bits of one integer;
    the trade id then is the only distinct count and rows are not expanded.
    """
    monthly = trades.groupBy(
        F.year("trade_date").alias("trade_year"),
        F.month("trade_date").alias("trade_month"),
        "product_type",
        "customer_code",
    ).agg(
        F.count_distinct("trade_id").alias("trade_count"),
        F.bit_or(F.expr("shiftleft(1L, dayofmonth(trade_date))")).alias("_days"),
        F.sum("amount").alias("turnover_amount"),
    )
    who = customers.select("customer_code", "customer_name", "current_segment")
    return monthly.join(who, "customer_code").select(
        "trade_year", "trade_month", "product_type", "customer_code", "customer_name",
        "current_segment", "trade_count",
        F.coalesce(F.bit_count("_days"), F.lit(0)).cast("bigint").alias("trading_days"),
        "turnover_amount",
        safe_ratio(F.col("turnover_amount"), F.col("trade_count")).alias("avg_amount_per_trade"),
    )


@_report(
    "rpt_aum_summary",
    [
        "fact_account_balance_daily", "dim_account", "dim_customer", "dim_customer_broker_history",
        "dim_broker",
    ],
)
def aum_summary(
    balances: DataFrame, accounts: DataFrame, customers: DataFrame, history: DataFrame, brokers: DataFrame
) -> DataFrame:
    """Balances credited to the broker who held the customer on the balance date."""
    owner = accounts.select("product_type", "account_id", "customer_code")
    who = customers.select("customer_code", "customer_name")
    held = history.select(
        F.col("customer_code").alias("_customer"), "broker_code", "valid_from", "valid_to"
    )
    unit = brokers.select(
        F.col("broker_code").alias("_broker"), "broker_name", "department_id", "department_name",
        "branch_id", "branch_name",
    )
    owned = balances.join(owner, ["product_type", "account_id"]).join(who, "customer_code")
    dated = pit_join(owned, held, [("customer_code", "_customer")], "balance_date")
    return dated.join(unit, F.col("broker_code") == F.col("_broker"), "left").select(
        "balance_date", "product_type", "customer_code", "customer_name", "broker_code",
        "broker_name", "department_id", "department_name", "branch_id", "branch_name",
        "account_id", "cash_balance", "portfolio_value", "total_asset_value",
    )


@_report("aum_rollup", ["rpt_aum_summary"])
def aum_rollup(aum: DataFrame) -> DataFrame:
    """Assets per day and broker, rolled up to branch and firm."""
    daily = aum.groupBy("balance_date", "branch_id", "broker_code").agg(
        F.sum("total_asset_value").alias("_value"), F.count(F.lit(1)).alias("_accounts")
    )
    branch, broker = F.col("branch_id"), F.col("broker_code")
    no_id, no_code = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    levels = struct_rows(
        ["level", "b", "k"],
        (F.lit("BROKER"), branch, broker),
        (F.lit("BRANCH"), branch, no_code),
        (F.lit("FIRM"), no_id, no_code),
    )
    return (
        daily.withColumn("u", F.explode(levels))
        .groupBy(
            "balance_date", F.col("u.level").alias("level"), F.col("u.b").alias("branch_id"),
            F.col("u.k").alias("broker_code"),
        )
        .agg(F.sum("_value").alias("total_asset_value"), F.sum("_accounts").alias("account_rows"))
    )


@_report(
    "rpt_customer_acquisition_funnel",
    ["stg_common__customer_acquisition", "dim_broker", "int_all_trades"],
)
def customer_acquisition_funnel(
    acquisition: DataFrame, brokers: DataFrame, trades: DataFrame
) -> DataFrame:
    """New and converted customers per month, channel, campaign and referrer."""
    traders = (
        trades.where(F.col("customer_code").isNotNull())
        .groupBy(F.col("customer_code").alias("_trader"))
        .agg(F.min("trade_date").alias("_first"))
    )
    keys = [
        F.year("acquisition_date").alias("acquisition_year"),
        F.month("acquisition_date").alias("acquisition_month"),
        "acquisition_channel", "campaign_code", "referral_broker_code",
    ]
    people = acquisition.join(traders, F.col("customer_code") == F.col("_trader"), "left")
    # One row per customer and group: both counts become plain counts.
    per_customer = people.groupBy(*keys, "customer_code").agg(F.max("_first").alias("_first"))
    funnel = per_customer.groupBy(
        "acquisition_year", "acquisition_month", "acquisition_channel", "campaign_code",
        "referral_broker_code",
    ).agg(
        F.count("customer_code").alias("new_customer_count"),
        F.count("_first").alias("converted_to_trading_count"),
    )
    names = brokers.select(
        F.col("broker_code").alias("_broker"), F.col("broker_name").alias("referral_broker_name")
    )
    return funnel.join(names, F.col("referral_broker_code") == F.col("_broker"), "left").select(
        "acquisition_year", "acquisition_month", "acquisition_channel", "campaign_code",
        "referral_broker_code", "referral_broker_name", "new_customer_count",
        "converted_to_trading_count",
        safe_ratio(F.col("converted_to_trading_count"), F.col("new_customer_count")).alias(
            "conversion_rate"
        ),
    )


@_report("rpt_customer_dormant", ["dim_customer", "int_all_trades", "dim_broker"], uses_as_of=True)
def customer_dormant(
    customers: DataFrame, trades: DataFrame, brokers: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """Active customers with their last trade; dormant when none or 90 days ago or more."""
    last = trades.groupBy("customer_code").agg(F.max("trade_date").alias("last_trade_date"))
    names = brokers.select(
        F.col("broker_code").alias("_broker"), F.col("broker_name").alias("current_broker_name")
    )
    days = F.datediff(_day(as_of), F.col("last_trade_date"))
    return (
        customers.where("is_active")
        .join(last, "customer_code", "left")
        .join(names, F.col("current_broker_code") == F.col("_broker"), "left")
        .select(
            "customer_code", "customer_name", "current_segment", "current_broker_code",
            "current_broker_name", "last_trade_date",
            days.alias("days_since_last_trade"),
            flag(F.col("last_trade_date").isNull(), days >= DORMANT_DAYS).alias("is_dormant"),
        )
    )


@_report("rpt_position_concentration_risk", ["fact_position_daily", "dim_account"])
def position_concentration_risk(positions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Share of each position in its customer's day total, and the firm-wide holding."""
    owner = accounts.select("product_type", "account_id", "customer_code").where("customer_code is not null")
    # Without a day a position has no day total.
    owned = positions.where("position_date is not null").join(owner, ["product_type", "account_id"]).select(
        "position_date", "product_type", "instrument_id", "customer_code", "market_value"
    )
    # An instrument's day may be hot, hence the join; a customer's day is a small group, so its
    # total is a window and the positions are not computed once more for it.
    day = Window.partitionBy("customer_code", "position_date")
    firm = window_total(
        owned, "market_value", ["position_date", "product_type", "instrument_id"],
        "firm_wide_market_value_in_instrument",
    ).withColumn("customer_total_market_value", F.sum("market_value").over(day))
    return firm.select(
        "position_date", "product_type", "instrument_id", "customer_code", "market_value",
        "customer_total_market_value",
        safe_ratio(F.col("market_value"), F.col("customer_total_market_value")).alias(
            "pct_of_customer_portfolio"
        ),
        "firm_wide_market_value_in_instrument",
    )


def _margin_report(
    loans: DataFrame, accounts: DataFrame, customers: DataFrame, brokers: DataFrame
) -> DataFrame:
    owner = accounts.select("product_type", "account_id", "account_no", "customer_code")
    who = customers.select("customer_code", "customer_name", "current_broker_code")
    names = brokers.select(F.col("broker_code").alias("_broker"), "broker_name")
    return (
        loans.join(owner, ["product_type", "account_id"])
        .join(who, "customer_code")
        .join(names, F.col("current_broker_code") == F.col("_broker"), "left")
        .select(
            "loan_date", "product_type", "account_id", "account_no", "customer_code",
            "customer_name", "current_broker_code", "broker_name", "margin_loan_balance",
            "margin_ratio", "maintenance_margin_ratio", "call_margin_flag",
            flag(
                F.col("call_margin_flag"),
                F.col("margin_ratio") < F.col("maintenance_margin_ratio"),
            ).alias("needs_attention"),
        )
    )


_MARGIN_DEPS = ["fact_margin_loan_daily", "dim_account", "dim_customer", "dim_broker"]


@_report("rpt_margin_call_alert", _MARGIN_DEPS)
def margin_call_alert(loans, accounts, customers, brokers) -> DataFrame:
    """Loans of the single latest date over all products."""
    return _margin_report(latest_slice(loans, "loan_date"), accounts, customers, brokers)


@_report("margin_call_alert_per_product", _MARGIN_DEPS)
def margin_call_alert_per_product(loans, accounts, customers, brokers) -> DataFrame:
    """Variant: the latest date of each product, so a product that stopped earlier stays."""
    latest = latest_slice(loans, "loan_date", per=["product_type"])
    return _margin_report(latest, accounts, customers, brokers)


@_report("rpt_oef_fund_flow", ["stg_oef__oef_trade", "dim_fund", "stg_oef__fund_nav_history"])
def oef_fund_flow(trades: DataFrame, funds: DataFrame, navs: DataFrame) -> DataFrame:
    """Subscriptions, redemptions and net flow per day and fund, with the day's NAV."""
    amount, kind = F.col("amount"), F.col("transaction_type")
    zero = F.lit(0).cast("decimal(20,2)")
    subscribed = F.when(kind == "SUBSCRIBE", amount).otherwise(zero)
    redeemed = F.when(kind == "REDEEM", amount).otherwise(zero)
    daily = trades.groupBy("trade_date", "fund_id").agg(
        F.sum(subscribed).alias("subscribe_amount"),
        F.sum(redeemed).alias("redeem_amount"),
        F.sum(
            F.when(kind == "SUBSCRIBE", amount).when(kind == "REDEEM", -amount).otherwise(zero)
        ).alias("net_flow_amount"),
        F.count_distinct("customer_code").alias("trading_customer_count"),
    )
    fund = funds.select("fund_id", "fund_code", "fund_name")
    nav = navs.select("fund_id", F.col("nav_date").alias("trade_date"), "nav_price")
    return (
        daily.join(fund, "fund_id")
        .join(nav, ["fund_id", "trade_date"], "left")
        .select(
            "trade_date", "fund_id", "fund_code", "fund_name", "nav_price", "subscribe_amount",
            "redeem_amount", "net_flow_amount", "trading_customer_count",
        )
    )


@_report(
    "rpt_customer_investment_performance",
    ["fact_account_balance_daily", "dim_account", "stg_common__market_index_price", "dim_customer"],
)
def customer_investment_performance(
    balances: DataFrame, accounts: DataFrame, index_prices: DataFrame, customers: DataFrame
) -> DataFrame:
    """Monthly return per customer against the index.

    Asset values are summed over a customer's accounts per day before the month's first and
    last day are taken, so the result does not depend on the order of accounts.
    """
    owner = accounts.select("product_type", "account_id", "customer_code")
    daily = (
        balances.join(owner, ["product_type", "account_id"])
        .groupBy("customer_code", "balance_date")
        .agg(F.sum("total_asset_value").alias("_value"))
    )
    monthly = daily.groupBy(
        "customer_code",
        F.year("balance_date").alias("value_year"),
        F.month("balance_date").alias("value_month"),
    ).agg(
        F.min_by("_value", "balance_date").alias("start_value"),
        F.max_by("_value", "balance_date").alias("end_value"),
    )
    index = (
        index_prices.where(F.col("index_code") == INDEX_CODE)
        .groupBy(F.year("price_date").alias("value_year"), F.month("price_date").alias("value_month"))
        .agg(
            F.min_by("close_value", "price_date").alias("_start_index"),
            F.max_by("close_value", "price_date").alias("_end_index"),
        )
    )
    who = customers.select("customer_code", "customer_name")
    own = safe_ratio(F.col("end_value") - F.col("start_value"), F.col("start_value"))
    market = safe_ratio(F.col("_end_index") - F.col("_start_index"), F.col("_start_index"))
    return (
        monthly.join(who, "customer_code")
        .join(index, ["value_year", "value_month"], "left")
        .select(
            "customer_code", "customer_name", "value_year", "value_month", "start_value",
            "end_value",
            own.alias("customer_return_pct"),
            market.alias("vnindex_return_pct"),
            (own - market).alias("excess_return_vs_vnindex"),
        )
    )


@_report("rpt_customer_cross_sell", ["dim_customer", "int_all_trades", "dim_broker"])
def customer_cross_sell(customers: DataFrame, trades: DataFrame, brokers: DataFrame) -> DataFrame:
    """Products each active customer uses; an opportunity when at most one."""

    def uses(product: str):
        return F.max(F.when(F.col("product_type") == product, 1).otherwise(0))

    usage = trades.groupBy("customer_code").agg(
        uses("EQUITY").alias("_e"), uses("DERIVATIVES").alias("_d"), uses("OEF").alias("_o")
    )
    names = brokers.select(F.col("broker_code").alias("_broker"), "broker_name")
    equity, derivatives, oef = (F.coalesce(c, F.lit(0)) for c in ("_e", "_d", "_o"))
    total = equity + derivatives + oef
    return (
        customers.where("is_active")
        .join(usage, "customer_code", "left")
        .join(names, F.col("current_broker_code") == F.col("_broker"), "left")
        .select(
            "customer_code", "customer_name", "current_segment", "current_broker_code",
            "broker_name",
            equity.alias("uses_equity"),
            derivatives.alias("uses_derivatives"),
            oef.alias("uses_oef"),
            total.alias("product_count"),
            flag(total <= 1).alias("is_cross_sell_opportunity"),
        )
    )


def _unit_revenue(trades: DataFrame, brokers: DataFrame) -> DataFrame:
    """Monthly fee revenue per department and per branch, in one pass over the trades."""
    per_broker = trades.groupBy(
        F.year("trade_date").alias("trade_year"),
        F.month("trade_date").alias("trade_month"),
        "broker_code",
    ).agg(F.sum("fee_amount").alias("_fee"))
    unit = brokers.select("broker_code", "department_id", "branch_id")
    levels = struct_rows(
        ["level", "id"],
        (F.lit("HEAD_OF_DEPARTMENT"), F.col("department_id")),
        (F.lit("BRANCH_DIRECTOR"), F.col("branch_id")),
    )
    return (
        per_broker.join(unit, "broker_code")
        .withColumn("u", F.explode(levels))
        .groupBy(
            "trade_year", "trade_month", F.col("u.level").alias("management_level"),
            F.col("u.id").alias("org_unit_id"),
        )
        # 28 digits leave room for the rate's six places in the product below.
        .agg(F.sum("_fee").cast("decimal(28,2)").alias("subordinate_revenue"))
    )


def _override(
    revenue: DataFrame, departments: DataFrame, branches: DataFrame, employees: DataFrame
) -> DataFrame:
    """Attach unit and manager; ``revenue`` already carries ``commission_rate``."""
    units = departments.select(
        F.lit("HEAD_OF_DEPARTMENT").alias("management_level"),
        F.col("department_id").alias("org_unit_id"),
        F.col("department_name").alias("org_unit_name"),
        F.col("head_employee_code").alias("employee_code"),
    ).unionByName(
        branches.select(
            F.lit("BRANCH_DIRECTOR").alias("management_level"),
            F.col("branch_id").alias("org_unit_id"),
            F.col("branch_name").alias("org_unit_name"),
            F.col("director_employee_code").alias("employee_code"),
        )
    )
    people = employees.where(F.col("employee_code").isNotNull()).select(
        "employee_code",
        F.col("full_name").alias("employee_name"),
        F.col("position").alias("employee_position"),
    )
    return (
        revenue.join(
            units.where(F.col("employee_code").isNotNull()), ["management_level", "org_unit_id"]
        )
        .join(people, "employee_code", "left")
        .select(
            "trade_year", "trade_month", "management_level", "org_unit_id", "org_unit_name",
            "employee_code", "employee_name", "employee_position", "subordinate_revenue",
            "commission_rate",
            (F.col("subordinate_revenue") * F.col("commission_rate")).alias(
                "override_commission_amount"
            ),
        )
    )


_OVERRIDE_DEPS = [
    "int_all_trades", "dim_broker", "dim_department", "dim_branch",
    "dim_management_commission_schedule", "dim_employee",
]


@_report("rpt_management_override_commission", _OVERRIDE_DEPS)
def management_override_commission(
    trades, brokers, departments, branches, schedule, employees
) -> DataFrame:
    """Override commission of heads and directors at today's current rate."""
    current = schedule.where("is_current").select("management_level", "commission_rate")
    revenue = _unit_revenue(trades, brokers).join(current, "management_level", "left")
    return _override(revenue, departments, branches, employees)


@_report("management_override_effective", _OVERRIDE_DEPS)
def management_override_effective(
    trades, brokers, departments, branches, schedule, employees
) -> DataFrame:
    """Variant: the rate in force on the first day of the month."""
    rates = schedule.select(
        F.col("management_level").alias("_level"), "commission_rate", "effective_from", "effective_to"
    )
    revenue = _unit_revenue(trades, brokers).withColumn(
        "_month", F.make_date("trade_year", "trade_month", F.lit(1))
    )
    rated = pit_join(
        revenue, rates, [("management_level", "_level")], "_month", "effective_from", "effective_to"
    )
    return _override(rated, departments, branches, employees)


MONEY = ["trade_amount", "fee_revenue", "broker_commission_amount"]


def _rated_words(words: DataFrame, brokers: DataFrame, rates: DataFrame) -> DataFrame:
    """Sets of trade ids with their broker's unit and the commission of their fees. A set stays one
    however many rates overlap; its sums are repeated as they are in the commission report."""
    unit = brokers.select("broker_code", "department_id", "branch_id")
    schedule = rates.select(F.col("product_type").alias("_product"), "commission_rate", "effective_from", "effective_to")
    rated = pit_join(
        words.join(unit, "broker_code"), schedule, [("product_type", "_product")], "trade_date", "effective_from", "effective_to"
    )
    return rated.withColumn("broker_commission_amount", F.col("fee_revenue") * F.col("commission_rate"))


@_report("commission_rollup", ["int_trade_id_words", "dim_broker", "dim_fee_schedule"])
def commission_rollup(words: DataFrame, brokers: DataFrame, rates: DataFrame) -> DataFrame:
    """Distinct trades and commission per quarter, rolled up broker, department, branch, firm.

    Each broker's quarter knows how many trades it adds to its department, branch and the firm, so
    the roll-up expands one row per broker and quarter, not the sets.
    """
    dated = _rated_words(words, brokers, rates).withColumns({"year": F.year("trade_date"), "quarter": F.quarter("trade_date")})
    units, counts = ["branch_id", "department_id", "broker_code"], ["_firm", "_branch", "_department", "_broker"]
    quarterly = count_nested(dated, ["year", "quarter"], units, counts, MONEY)
    branch, department, broker = F.col("branch_id"), F.col("department_id"), F.col("broker_code")
    no_id, no_code = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    unit = struct_rows(
        ["level", "b", "d", "k", "n"],
        (F.lit("BROKER"), branch, department, broker, F.col("_broker")),
        (F.lit("DEPARTMENT"), branch, department, no_code, F.col("_department")),
        (F.lit("BRANCH"), branch, no_id, no_code, F.col("_branch")),
        (F.lit("FIRM"), no_id, no_id, no_code, F.col("_firm")),
    )
    levels = quarterly.withColumn("u", F.explode(unit)).select(
        "year", "quarter", F.col("u.level").alias("level"), F.col("u.b").alias("branch_id"),
        F.col("u.d").alias("department_id"), F.col("u.k").alias("broker_code"), F.col("u.n").alias("trade_count"), *MONEY,
    )
    by = ["year", "quarter", "level", "branch_id", "department_id", "broker_code"]
    return levels.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("trade_count", *MONEY)])


@_report("commission_calendar", ["int_trade_id_words", "dim_broker", "dim_fee_schedule", "dim_date"])
def commission_calendar(words: DataFrame, brokers: DataFrame, rates: DataFrame, calendar: DataFrame) -> DataFrame:
    """Distinct trades and commission per calendar week, month and quarter, by product and branch.

    Brokers' sets and sums are merged per day and branch before they meet the calendar. A week
    belongs to the day it starts on, so one that crosses the year's end is whole.
    """
    daily = merge_words(_rated_words(words, brokers, rates), ["trade_date", "product_type", "branch_id"], MONEY)
    day = F.col("date_key")
    span = struct_rows(
        ["period", "no", "start"],
        (F.lit("WEEK"), F.col("week_of_year"), F.trunc(day, "week")),
        (F.lit("MONTH"), F.col("month"), F.trunc(day, "month")),
        (F.lit("QUARTER"), F.col("quarter"), F.trunc(day, "quarter")),
    )
    dated = daily.join(calendar, F.col("trade_date") == day).withColumn("p", F.explode(span)).select(
        F.col("p.period").alias("period"), F.col("p.no").alias("period_no"), F.col("p.start").alias("period_start"),
        "product_type", "branch_id", WORD, BITS, *MONEY,
    )
    return count_words(dated, ["period", "period_no", "period_start", "product_type", "branch_id"], "trade_count", MONEY)


@_report("foreign_net_flow", ["fact_equity_trade", "stg_common__customer"])
def foreign_net_flow(trades: DataFrame, customers: DataFrame) -> DataFrame:
    """Bought, sold and net value per day and residency of the customer.

    Trades are summed per day and customer before they meet the customer table.
    """
    zero = F.lit(0).cast("decimal(20,2)")
    per_customer = trades.groupBy("trade_date", "customer_code").agg(
        F.sum(F.when(F.col("side") == "BUY", F.col("amount")).otherwise(zero)).alias("_buy"),
        F.sum(F.when(F.col("side") == "SELL", F.col("amount")).otherwise(zero)).alias("_sell"),
    )
    who = customers.select("customer_code", "residency")
    return (
        per_customer.join(who, "customer_code")
        .groupBy("trade_date", "residency")
        .agg(F.sum("_buy").alias("buy_amount"), F.sum("_sell").alias("sell_amount"))
        .withColumn("net_amount", F.col("buy_amount") - F.col("sell_amount"))
    )


@_report(
    "alert_trade_link",
    ["stg_common__trading_alert", "fact_equity_trade", "fact_derivative_trade", "fact_oef_trade"],
)
def alert_trade_link(alerts, equity, derivatives, oef) -> DataFrame:
    """Alerts with the trade they point to by (product, source system, source trade id)."""
    cols = ("product_type", "source_system", "source_trade_id", "trade_date", "amount")
    trades = equity.select(*cols).unionByName(derivatives.select(*cols)).unionByName(oef.select(*cols))
    linked = trades.select(
        F.col("product_type").alias("related_product_type"),
        F.col("source_system").alias("related_source_system"),
        F.col("source_trade_id").alias("related_trade_id"),
        F.col("trade_date").alias("linked_trade_date"),
        F.col("amount").alias("linked_amount"),
    )
    keys = ["related_product_type", "related_source_system", "related_trade_id"]
    return alerts.join(linked, keys, "left").select(
        "alert_id", "alert_date", "alert_type", "severity", "status", *keys, "linked_trade_date",
        "linked_amount",
    )


@_report(
    "compliance_summary",
    ["dim_broker", "stg_common__trading_alert", "stg_common__customer_complaint"],
)
def compliance_summary(brokers, alerts, complaints) -> DataFrame:
    """Alerts and complaints per broker."""
    a = alerts.groupBy("broker_code").agg(
        F.count(F.lit(1)).alias("_alerts"),
        F.count_if(F.col("severity") == "HIGH").alias("_high"),
        F.count_if(F.col("status") != "CLOSED").alias("_open_alerts"),
    )
    c = complaints.groupBy("broker_code").agg(
        F.count(F.lit(1)).alias("_complaints"),
        F.count_if(F.col("resolution_date").isNull()).alias("_unresolved"),
        F.sum(F.datediff("resolution_date", "complaint_date")).alias("_days"),
        F.count("resolution_date").alias("_resolved"),
    )
    return (
        brokers.join(a, "broker_code", "left")
        .join(c, "broker_code", "left")
        .select(
            "broker_code", "broker_name",
            F.coalesce("_alerts", F.lit(0)).alias("alert_count"),
            F.coalesce("_high", F.lit(0)).alias("high_alert_count"),
            F.coalesce("_open_alerts", F.lit(0)).alias("open_alert_count"),
            F.coalesce("_complaints", F.lit(0)).alias("complaint_count"),
            F.coalesce("_unresolved", F.lit(0)).alias("unresolved_count"),
            safe_ratio(F.col("_days"), F.col("_resolved")).alias("avg_resolution_days"),
        )
    )
