"""Domain schemas: enumerations, payload types of the landed tables, keys."""

from __future__ import annotations

from dataclasses import dataclass

PRODUCTS = ("EQUITY", "DERIVATIVES", "OEF")

# The domain's enumerations.
ENUMS = {
    "broker_type": ("BROKER", "COLLABORATOR"),
    "broker_subtype": {
        "BROKER": ("STANDARD", "SENIOR", "TEAM_LEAD", "RM_VIP"),
        "COLLABORATOR": (
            "REFERRAL_INDIVIDUAL",
            "REFERRAL_AFFILIATE",
            "REFERRAL_INSTITUTIONAL",
        ),
    },
    "customer_type": ("INDIVIDUAL", "ORGANIZATION", "PROPRIETARY"),
    "residency": ("DOMESTIC", "FOREIGN"),
    "investor_classification": ("PROFESSIONAL", "NON_PROFESSIONAL"),
    "risk_level": ("LOW", "MEDIUM", "HIGH"),
    "segment": ("VIP", "PRIORITY", "RETAIL"),
    "product_type": PRODUCTS,
    "management_level": ("HEAD_OF_DEPARTMENT", "BRANCH_DIRECTOR"),
    "alert_severity": ("LOW", "MEDIUM", "HIGH"),
    "alert_status": ("OPEN", "REVIEWING", "CLOSED", "ESCALATED"),
    "complaint_status": ("OPEN", "IN_PROGRESS", "RESOLVED", "CLOSED"),
    "side": ("BUY", "SELL"),
    "position_side": ("LONG", "SHORT"),
    "order_action": ("OPEN", "CLOSE"),
    "transaction_type": ("SUBSCRIBE", "REDEEM", "SWITCH"),
}


@dataclass(frozen=True)
class Landed:
    """A heavy table that lands as VARIANT rows: payload types and natural key."""

    domain: str
    table: str
    payload: dict[str, str]
    keys: tuple[str, ...]

    @property
    def raw(self) -> str:
        return f"{self.domain}.{self.table}_raw"

    @property
    def staged(self) -> str:
        return f"stg_{self.domain}__{self.table}"


def _payload(text: str) -> dict[str, str]:
    out = {}
    for item in text.split(";"):
        name, kind = item.strip().split(" ")
        out[name] = kind
    return out


_TRADE_KEY = ("source_system", "source_trade_id")
_BALANCE = _payload(
    "balance_date date; account_id bigint; cash_balance decimal(20,2); "
    "portfolio_value decimal(20,2); total_asset_value decimal(20,2)"
)
_MARGIN = _payload(
    "loan_date date; account_id bigint; margin_loan_balance decimal(20,2); "
    "margin_ratio decimal(9,4); maintenance_margin_ratio decimal(9,4); call_margin_flag boolean"
)

# The eleven landed tables and the types their payload is read as.
LANDED = (
    Landed(
        "equity",
        "equity_trade",
        _payload(
            "trade_id bigint; trade_date date; trade_datetime timestamp_ntz; source_trade_id string; "
            "account_no string; customer_code string; broker_code string; security_id bigint; "
            "market string; side string; order_type string; quantity decimal(18,0); "
            "price decimal(18,2); amount decimal(20,2); fee_amount decimal(18,2); "
            "tax_amount decimal(18,2); settlement_date date; order_id string; source_system string; "
            "ingested_at timestamp_ntz"
        ),
        _TRADE_KEY,
    ),
    Landed("equity", "account_balance_daily", _BALANCE, ("account_id", "balance_date")),
    Landed(
        "equity",
        "position_daily",
        _payload(
            "position_date date; account_id bigint; security_id bigint; quantity decimal(20,4); "
            "avg_cost_price decimal(18,4); market_value decimal(20,2)"
        ),
        ("account_id", "security_id", "position_date"),
    ),
    Landed("equity", "margin_loan_daily", _MARGIN, ("account_id", "loan_date")),
    Landed(
        "derivatives",
        "derivative_trade",
        _payload(
            "trade_id bigint; trade_date date; trade_datetime timestamp_ntz; source_trade_id string; "
            "account_no string; customer_code string; broker_code string; contract_id bigint; "
            "position_side string; order_action string; quantity decimal(18,0); price decimal(18,2); "
            "amount decimal(20,2); margin_amount decimal(20,2); fee_amount decimal(18,2); "
            "settlement_date date; order_id string; source_system string; ingested_at timestamp_ntz"
        ),
        _TRADE_KEY,
    ),
    Landed("derivatives", "account_balance_daily", _BALANCE, ("account_id", "balance_date")),
    Landed(
        "derivatives",
        "position_daily",
        _payload(
            "position_date date; account_id bigint; contract_id bigint; position_side string; "
            "quantity decimal(20,4); avg_cost_price decimal(18,4); market_value decimal(20,2)"
        ),
        ("account_id", "contract_id", "position_date"),
    ),
    Landed("derivatives", "margin_loan_daily", _MARGIN, ("account_id", "loan_date")),
    Landed(
        "oef",
        "oef_trade",
        _payload(
            "trade_id bigint; trade_date date; trade_datetime timestamp_ntz; source_trade_id string; "
            "account_no string; customer_code string; broker_code string; fund_id bigint; "
            "transaction_type string; quantity_unit decimal(20,4); nav_price decimal(18,4); "
            "amount decimal(20,2); fee_amount decimal(18,2); settlement_date date; order_id string; "
            "source_system string; ingested_at timestamp_ntz"
        ),
        _TRADE_KEY,
    ),
    Landed("oef", "account_balance_daily", _BALANCE, ("account_id", "balance_date")),
    Landed(
        "oef",
        "position_daily",
        _payload(
            "position_date date; account_id bigint; fund_id bigint; quantity_unit decimal(20,4); "
            "avg_cost_nav decimal(18,4); market_value decimal(20,2)"
        ),
        ("account_id", "fund_id", "position_date"),
    ),
)
LANDED_BY_STAGED = {t.staged: t for t in LANDED}

# Columns of the pass-through staging tables, per source table.
PASSTHROUGH = {
    "common.branch": "branch_id branch_code branch_name address director_employee_code is_active "
    "source_system source_updated_at ingested_at",
    "common.broker": "broker_code broker_name broker_type broker_subtype department_id employee_code "
    "id_number phone email start_date end_date is_active source_system source_updated_at ingested_at",
    # The customer's identity number is left out on purpose.
    "common.customer": "customer_code customer_name customer_type residency phone email open_date "
    "is_active source_system ingested_at",
    "common.customer_acquisition": "customer_code acquisition_channel referral_broker_code "
    "acquisition_date campaign_code source_system ingested_at",
    "common.customer_broker_history": "history_id customer_code broker_code valid_from valid_to "
    "is_current source_system ingested_at",
    "common.customer_complaint": "complaint_id customer_code broker_code complaint_date channel "
    "category status resolution_date ingested_at",
    "common.customer_risk_profile": "history_id customer_code investor_classification risk_level "
    "valid_from valid_to is_current source_system ingested_at",
    "common.customer_segment_history": "history_id customer_code segment valid_from valid_to "
    "is_current source_system ingested_at",
    "common.department": "department_id department_code department_name branch_id department_type "
    "head_employee_code is_active source_system source_updated_at ingested_at",
    "common.fee_schedule": "fee_schedule_id product_type broker_tier fee_rate commission_rate "
    "effective_from effective_to is_current",
    "common.management_commission_schedule": "schedule_id management_level commission_rate "
    "effective_from effective_to is_current",
    "common.market_index_price": "price_date index_code close_value change_percent volume",
    "common.trading_alert": "alert_id alert_date customer_code broker_code related_product_type "
    "related_source_system related_trade_id alert_type severity status ingested_at",
    "equity.account": "account_id account_no customer_code broker_code open_date is_active",
    "equity.daily_price": "price_date security_id close_price reference_price ceiling_price "
    "floor_price volume",
    "equity.security": "security_id symbol security_name exchange sector security_type listing_date "
    "is_active",
    "derivatives.account": "account_id account_no customer_code broker_code open_date is_active",
    "derivatives.daily_settlement_price": "price_date contract_id settlement_price open_interest volume",
    "derivatives.derivative_contract": "contract_id contract_code underlying_symbol contract_type "
    "multiplier listing_date maturity_date is_active",
    "oef.account": "account_id account_no customer_code broker_code open_date is_active",
    "oef.fund": "fund_id fund_code fund_name fund_type fund_manager inception_date is_active",
    "oef.fund_nav_history": "nav_date fund_id nav_price total_net_asset outstanding_units",
    "hr.employee": "id_number employee_code full_name person_type branch_code branch_name "
    "department_code department_name position position_code position_level manager_employee_code "
    "start_date end_date status",
}

#: Tables replicated from the sources: 26 database tables (accounts and snapshots count once
#: per name) and the employee registry.
SELECTED_STREAMS = tuple(
    sorted({n.split(".")[1] for n in PASSTHROUGH} | {t.table for t in LANDED})
)

EMPLOYEE_SCHEMA = ", ".join(f"{c} string" for c in PASSTHROUGH["hr.employee"].split())
