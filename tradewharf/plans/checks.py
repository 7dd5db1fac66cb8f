"""Quality checks of the gold layer and the constraints of the source tables."""

from __future__ import annotations

from tradewharf.operators.quality import Check
from tradewharf.schemas import ENUMS


def _table(name: str, missing: str = "", unique: str = "", extra: tuple[Check, ...] = ()) -> list[Check]:
    out = [Check(name, "row_count")]
    out += [Check(name, "missing", (c,)) for c in missing.split()]
    out += [Check(name, "duplicates", tuple(k.split("+"))) for k in unique.split()]
    return out + list(extra)


def _accepted(table: str, column: str, enum: str) -> Check:
    return Check(table, "accepted_values", (column,), values=ENUMS[enum])


def _parent(table: str, column: str, parent: str, key: str) -> Check:
    return Check(table, "orphans", (column,), parent=parent, parent_key=key)


def _trade(table: str, day: str = "trade_date") -> tuple[Check, ...]:
    return (
        Check(table, "freshness", ("ingested_at",), fail_hours=24),
        Check(table, "anomaly", (day,), options={"look_back": 7, "sensitivity": 0.7}),
    )


GOLD_CHECKS: tuple[Check, ...] = tuple(
    _table("dim_broker", "broker_code", "broker_code", (_accepted("dim_broker", "broker_type", "broker_type"),))
    + _table(
        "dim_customer", "customer_code customer_type", "customer_code",
        (
            _accepted("dim_customer", "customer_type", "customer_type"),
            _accepted("dim_customer", "residency", "residency"),
        ),
    )
    # Account ids repeat across products, so the composite key is what must be unique.
    + _table("dim_account", "account_id", "product_type+account_id")
    + _table("dim_security", "security_id", "security_id")
    + _table("dim_branch", "branch_id branch_code", "branch_id")
    + _table("dim_department", "department_id department_code", "department_id")
    + _table("dim_derivative_contract", "contract_id contract_code", "contract_id")
    + _table("dim_fund", "fund_id fund_code", "fund_id")
    + _table("dim_date", "date_key", "date_key")
    + _table(
        "fact_equity_trade", "trade_id source_trade_id quantity amount", "trade_id source_trade_id",
        (
            _accepted("fact_equity_trade", "side", "side"),
            _parent("fact_equity_trade", "customer_code", "dim_customer", "customer_code"),
            _parent("fact_equity_trade", "security_id", "dim_security", "security_id"),
            *_trade("fact_equity_trade"),
        ),
    )
    + _table(
        "fact_derivative_trade", "trade_id source_trade_id", "trade_id source_trade_id",
        (
            _accepted("fact_derivative_trade", "position_side", "position_side"),
            _parent("fact_derivative_trade", "contract_id", "dim_derivative_contract", "contract_id"),
            *_trade("fact_derivative_trade"),
        ),
    )
    + _table(
        "fact_oef_trade", "trade_id source_trade_id", "trade_id source_trade_id",
        (
            _accepted("fact_oef_trade", "transaction_type", "transaction_type"),
            _parent("fact_oef_trade", "fund_id", "dim_fund", "fund_id"),
            *_trade("fact_oef_trade"),
        ),
    )
    + _table(
        "rpt_broker_commission_revenue", "broker_code", "",
        (Check("rpt_broker_commission_revenue", "non_negative", ("broker_commission_amount",)),),
    )
    + _table(
        "rpt_aum_summary", "customer_code", "",
        (Check("rpt_aum_summary", "non_negative", ("total_asset_value",)),),
    )
    + _table(
        "rpt_margin_call_alert", "account_id", "",
        (Check("rpt_margin_call_alert", "non_negative", ("margin_ratio",)),),
    )
    + _table("rpt_trading_activity_summary", "trade_month")
    + _table("rpt_customer_acquisition_funnel", "acquisition_channel")
    + _table("rpt_customer_dormant", "customer_code")
    + _table("rpt_position_concentration_risk", "instrument_id")
    + _table("rpt_oef_fund_flow", "fund_code")
    + _table("rpt_customer_investment_performance", "customer_code")
    + _table("rpt_customer_cross_sell", "customer_code")
    + _table("rpt_management_override_commission", "employee_code")
    + _table("rpt_department_branch_ranking", "branch_id")
    + _table("rpt_broker_performance", "broker_code")
)

HISTORY_CHECKS: tuple[Check, ...] = tuple(
    _table(
        "dim_customer_history", "customer_code valid_from", "customer_code+valid_from"
    )
)

#: The captured snapshot itself.
SNAPSHOT_CHECKS: tuple[Check, ...] = tuple(
    _table("snap_customer_profile", "version_id customer_code", "version_id")
)

#: Load age of the common source tables: warning after 26 hours, failure after 50.
SOURCE_FRESHNESS: tuple[Check, ...] = tuple(
    Check(f"stg_common__{name}", "freshness", ("ingested_at",), warn_hours=26, fail_hours=50)
    for name in (
        "branch", "broker", "customer", "customer_acquisition", "customer_broker_history",
        "customer_complaint", "customer_risk_profile", "customer_segment_history", "department",
        "trading_alert",
    )
)


def _one_of(column: str, enum: str) -> str:
    return f"{column} in ({', '.join(repr(v) for v in ENUMS[enum])})"


def _constraint(table: str, name: str, expr: str) -> Check:
    return Check(table, "constraint", expr=expr, name=name)


_SUBTYPE = " or ".join(
    f"(broker_type = {kind!r} and broker_subtype in ({', '.join(repr(v) for v in subs)}))"
    for kind, subs in ENUMS["broker_subtype"].items()
)

#: Row constraints of the source tables. As in the sources, an unknown (NULL) outcome passes.
CONSTRAINTS: tuple[Check, ...] = (
    _constraint("stg_common__broker", "broker_type", _one_of("broker_type", "broker_type")),
    _constraint("stg_common__broker", "employee_code_for_broker", "broker_type <> 'BROKER' or employee_code is not null"),
    _constraint("stg_common__broker", "broker_subtype", _SUBTYPE),
    _constraint("stg_common__customer", "customer_type", _one_of("customer_type", "customer_type")),
    _constraint("stg_common__customer", "residency", _one_of("residency", "residency")),
    _constraint("stg_common__customer", "proprietary_residency", "customer_type <> 'PROPRIETARY' or residency = 'DOMESTIC'"),
    _constraint("stg_common__customer_broker_history", "dates", "valid_to is null or valid_to >= valid_from"),
    _constraint("stg_common__customer_risk_profile", "classification", _one_of("investor_classification", "investor_classification")),
    _constraint("stg_common__customer_risk_profile", "risk_level", _one_of("risk_level", "risk_level")),
    _constraint("stg_common__customer_risk_profile", "dates", "valid_to is null or valid_to >= valid_from"),
    _constraint("stg_common__customer_segment_history", "segment", _one_of("segment", "segment")),
    _constraint("stg_common__customer_segment_history", "dates", "valid_to is null or valid_to >= valid_from"),
    _constraint("stg_common__fee_schedule", "product_type", _one_of("product_type", "product_type")),
    _constraint("stg_common__management_commission_schedule", "management_level", _one_of("management_level", "management_level")),
    _constraint("stg_common__trading_alert", "severity", _one_of("severity", "alert_severity")),
    _constraint("stg_common__trading_alert", "status", _one_of("status", "alert_status")),
    _constraint("stg_common__customer_complaint", "status", _one_of("status", "complaint_status")),
    _constraint("fact_equity_trade", "side", _one_of("side", "side")),
    _constraint("fact_derivative_trade", "position_side", _one_of("position_side", "position_side")),
    _constraint("fact_derivative_trade", "order_action", _one_of("order_action", "order_action")),
    _constraint("fact_oef_trade", "transaction_type", _one_of("transaction_type", "transaction_type")),
    _constraint("stg_derivatives__position_daily", "position_side", _one_of("position_side", "position_side")),
    # Not a constraint of the source: a rate must not end before it begins.
    _constraint("stg_common__fee_schedule", "effective_dates", "effective_to is null or effective_to >= effective_from"),
)

#: Conditional uniqueness of the source tables; NULL tiers count as equal.
UNIQUE_WHERE: tuple[Check, ...] = (
    Check("stg_common__broker", "duplicates", ("id_number",), where="id_number is not null"),
    Check("stg_common__customer_broker_history", "duplicates", ("customer_code",), where="is_current"),
    Check("stg_common__customer_risk_profile", "duplicates", ("customer_code",), where="is_current"),
    Check("stg_common__customer_segment_history", "duplicates", ("customer_code",), where="is_current"),
    Check("stg_common__fee_schedule", "duplicates", ("product_type", "broker_tier"), where="is_current"),
    Check("stg_common__management_commission_schedule", "duplicates", ("management_level",), where="is_current"),
)
