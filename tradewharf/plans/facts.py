"""Facts of the gold layer and the common trade grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewharf.operators.distinct import id_words
from tradewharf.operators.relational import union_tagged
from tradewharf.registry import model
from tradewharf.schemas import LANDED_BY_STAGED

LAYER = "MARTS"
TRADE_KEY = ("source_system", "source_trade_id")
COMMON_TRADE = (
    "product_type", "trade_id", "trade_date", "customer_code", "broker_code", "account_no",
    "amount", "fee_amount",
)


def _trade_fact(name: str, staged: str, product: str) -> None:
    columns = tuple(LANDED_BY_STAGED[staged].payload)

    def build(trades: DataFrame) -> DataFrame:
        return trades.select(F.lit(product).alias("product_type"), *columns)

    model(
        name, LAYER, [staged], materialized="incremental", keys=TRADE_KEY,
        watermark="ingested_at", month_of="trade_date",
    )(build)


_trade_fact("fact_equity_trade", "stg_equity__equity_trade", "EQUITY")
_trade_fact("fact_derivative_trade", "stg_derivatives__derivative_trade", "DERIVATIVES")
_trade_fact("fact_oef_trade", "stg_oef__oef_trade", "OEF")


@model(
    "fact_account_balance_daily",
    LAYER,
    [
        "stg_equity__account_balance_daily",
        "stg_derivatives__account_balance_daily",
        "stg_oef__account_balance_daily",
    ],
    materialized="incremental",
    keys=("product_type", "account_id", "balance_date"),
    watermark="balance_date",
    per="product_type",
    month_of="balance_date",
)
def fact_account_balance_daily(equity: DataFrame, derivatives: DataFrame, oef: DataFrame) -> DataFrame:
    return union_tagged(
        {"EQUITY": equity, "DERIVATIVES": derivatives, "OEF": oef},
        "product_type",
        ("account_id", "balance_date", "cash_balance", "portfolio_value", "total_asset_value"),
    )


@model(
    "fact_position_daily",
    LAYER,
    ["stg_equity__position_daily", "stg_derivatives__position_daily", "stg_oef__position_daily"],
    materialized="incremental",
    keys=("product_type", "account_id", "instrument_id", "position_date"),
    watermark="position_date",
    per="product_type",
    month_of="position_date",
)
def fact_position_daily(equity: DataFrame, derivatives: DataFrame, oef: DataFrame) -> DataFrame:
    """Positions under one instrument id: security, contract or fund by product."""
    return union_tagged(
        {"EQUITY": equity, "DERIVATIVES": derivatives, "OEF": oef},
        "product_type",
        ("account_id", "instrument_id", "position_date", "quantity", "avg_cost", "market_value"),
        renames={
            "EQUITY": {"security_id": "instrument_id", "avg_cost_price": "avg_cost"},
            "DERIVATIVES": {"contract_id": "instrument_id", "avg_cost_price": "avg_cost"},
            "OEF": {
                "fund_id": "instrument_id",
                "quantity_unit": "quantity",
                "avg_cost_nav": "avg_cost",
            },
        },
    )


@model(
    "fact_margin_loan_daily",
    LAYER,
    ["stg_equity__margin_loan_daily", "stg_derivatives__margin_loan_daily"],
    materialized="incremental",
    keys=("product_type", "account_id", "loan_date"),
    watermark="loan_date",
    per="product_type",
    month_of="loan_date",
)
def fact_margin_loan_daily(equity: DataFrame, derivatives: DataFrame) -> DataFrame:
    """Margin loans; funds are not traded on margin."""
    return union_tagged(
        {"EQUITY": equity, "DERIVATIVES": derivatives},
        "product_type",
        (
            "account_id", "loan_date", "margin_loan_balance", "margin_ratio",
            "maintenance_margin_ratio", "call_margin_flag",
        ),
    )


@model(
    "int_all_trades",
    LAYER,
    ["fact_equity_trade", "fact_derivative_trade", "fact_oef_trade"],
    materialized="view",
)
def int_all_trades(equity: DataFrame, derivatives: DataFrame, oef: DataFrame) -> DataFrame:
    """Common grain of the three trade facts, cut to the shared columns before the union."""
    parts = [f.select(*COMMON_TRADE) for f in (equity, derivatives, oef)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@model("int_trade_id_words", LAYER, ["int_all_trades"], materialized="view")
def int_trade_id_words(trades: DataFrame) -> DataFrame:
    """Trade ids per day, product and broker as sets, with turnover and fees: what roll-ups of
    distinct trades and commission start from."""
    sums = {"trade_amount": F.col("amount"), "fee_revenue": F.col("fee_amount")}
    return id_words(trades, ["trade_date", "product_type", "broker_code"], "trade_id", sums)
