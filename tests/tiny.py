"""Two invented trading days: three brokers, two customers, five accounts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

DAY = dt.date(2025, 3, 12)
NEXT = DAY + dt.timedelta(days=1)
AT = dt.datetime(2025, 3, 14, 6)


def _rows(spark, schema, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def sources(spark) -> dict:
    d = dt.date
    stamp = "source_system string, source_updated_at timestamp_ntz, ingested_at timestamp_ntz"
    desk = ("DESK", None, AT)

    def history(attrs, *rows):
        return _rows(
            spark,
            f"history_id bigint, customer_code string, {attrs}, valid_from date, valid_to date, "
            "is_current boolean, source_system string, ingested_at timestamp_ntz",
            *[(*r, None, True, "DESK", AT) for r in rows],
        )

    account = (
        "account_id bigint, account_no string, customer_code string, broker_code string, "
        "open_date date, is_active boolean"
    )
    balance = (
        "balance_date date, account_id bigint, cash_balance decimal(20,2), "
        "portfolio_value decimal(20,2), total_asset_value decimal(20,2)"
    )
    loan = (
        "loan_date date, account_id bigint, margin_loan_balance decimal(20,2), margin_ratio decimal(9,4), "
        "maintenance_margin_ratio decimal(9,4), call_margin_flag boolean"
    )
    person = (
        "id_number string, employee_code string, full_name string, person_type string, branch_code string, "
        "branch_name string, department_code string, department_name string, position string, "
        "position_code string, position_level string, manager_employee_code string, start_date string, "
        "end_date string, status string"
    )
    start = d(2021, 2, 1)

    def person_row(no, name, unit, level, boss, kind="EMPLOYEE", code=True):
        branch = ("W", "West") if unit != "SALES-E" else ("E", "East")
        return (
            f"P{no}", f"E-{no}" if code else None, name, kind, *branch, unit, unit and unit.title(), level.title(), level, level,
            boss, "2018-05-01", None, "ACTIVE",
        )

    def equity_trade(no, day, account, who, broker, side, quantity, price, fee):
        at = dt.datetime.combine(day, dt.time(10, no))
        return (
            no, day, at, f"X{no}", account, who, broker, 90 + no % 2, "MAIN", side, None, D(quantity), D(price),
            D(quantity) * D(price), D(fee), None, None, None, "EXCHANGE", AT,
        )

    def money(day, *accounts):
        return [(day, a, D(cash), D(held), D(cash) + D(held)) for a, cash, held in accounts]

    return {
        "common.branch": _rows(
            spark,
            "branch_id bigint, branch_code string, branch_name string, address string, "
            f"director_employee_code string, is_active boolean, {stamp}",
            (7, "W", "West", "Quay 1", "E-22", True, *desk),
            (8, "E", "East", None, None, True, *desk),
        ),
        "common.department": _rows(
            spark,
            "department_id bigint, department_code string, department_name string, branch_id bigint, "
            f"department_type string, head_employee_code string, is_active boolean, {stamp}",
            (10, "SALES-W", "Sales West", 7, "BROKERAGE", "E-21", True, *desk),
            (20, "SALES-E", "Sales East", 8, "BROKERAGE", None, True, *desk),
        ),
        "common.broker": _rows(
            spark,
            "broker_code string, broker_name string, broker_type string, broker_subtype string, "
            "department_id bigint, employee_code string, id_number string, phone string, email string, "
            f"start_date date, end_date date, is_active boolean, {stamp}",
            ("RED", "Rita", "BROKER", "TEAM_LEAD", 10, "E-11", "P11", None, None, start, None, True, *desk),
            ("BLUE", "Bo", "BROKER", "RM_VIP", 20, "E-12", "P12", None, None, start, None, True, *desk),
            ("TAN", "Tim", "COLLABORATOR", "REFERRAL_AFFILIATE", 10, None, "P13", None, None, start, None, True, *desk),
        ),
        "common.customer": _rows(
            spark,
            "customer_code string, customer_name string, customer_type string, residency string, "
            f"id_number string, phone string, email string, open_date date, is_active boolean, {stamp}",
            ("ANN", "Ann", "INDIVIDUAL", "DOMESTIC", "i1", None, None, start, True, *desk),
            ("ORB", "Orb Ltd", "ORGANIZATION", "FOREIGN", "i2", None, None, start, True, *desk),
        ),
        "common.customer_broker_history": history("broker_code string", (1, "ANN", "RED", start), (2, "ORB", "BLUE", start)),
        "common.customer_risk_profile": history(
            "investor_classification string, risk_level string",
            (1, "ANN", "NON_PROFESSIONAL", "LOW", start), (2, "ORB", "PROFESSIONAL", "MEDIUM", start),
        ),
        "common.customer_segment_history": history("segment string", (1, "ANN", "PRIORITY", start), (2, "ORB", "RETAIL", start)),
        "common.customer_acquisition": _rows(
            spark,
            "customer_code string, acquisition_channel string, referral_broker_code string, "
            "acquisition_date date, campaign_code string, source_system string, ingested_at timestamp_ntz",
            ("ANN", "ONLINE", "TAN", start, "spring", "DESK", AT),
            ("ORB", "BRANCH", "BLUE", start, None, "DESK", AT),
        ),
        "common.fee_schedule": _rows(
            spark,
            "fee_schedule_id bigint, product_type string, broker_tier string, fee_rate decimal(9,6), "
            "commission_rate decimal(9,6), effective_from date, effective_to date, is_current boolean",
            (31, "EQUITY", None, D("0.005"), D("0.20"), start, None, True),
            (32, "DERIVATIVES", None, D("0.003"), D("0.10"), start, None, True),
            (33, "OEF", None, D("0.004"), D("0.40"), start, None, True),
        ),
        "common.management_commission_schedule": _rows(
            spark,
            "schedule_id bigint, management_level string, commission_rate decimal(9,6), effective_from date, "
            "effective_to date, is_current boolean",
            (41, "HEAD_OF_DEPARTMENT", D("0.04"), start, None, True),
            (42, "BRANCH_DIRECTOR", D("0.02"), start, None, True),
        ),
        "common.market_index_price": _rows(
            spark,
            "price_date date, index_code string, close_value decimal(18,2), change_percent decimal(9,4), volume decimal(20,0)",
            (DAY, "VNINDEX", D("1000"), None, None),
            (NEXT, "VNINDEX", D("1020"), D("2"), None),
        ),
        "equity.account": _rows(
            spark, account,
            (501, "S-501", "ANN", "RED", start, True), (502, "S-502", "ANN", "RED", start, True),
            (601, "S-601", "ORB", "BLUE", start, True),
        ),
        "derivatives.account": _rows(spark, account, (701, "F-701", "ORB", "BLUE", start, True)),
        "oef.account": _rows(spark, account, (801, "U-801", "ANN", "RED", start, True)),
        "oef.fund": _rows(
            spark,
            "fund_id bigint, fund_code string, fund_name string, fund_type string, fund_manager string, "
            "inception_date date, is_active boolean",
            (3, "BAL", "Balanced", "BALANCED_FUND", "House", start, True),
        ),
        "oef.fund_nav_history": _rows(
            spark,
            "nav_date date, fund_id bigint, nav_price decimal(18,4), total_net_asset decimal(24,2), outstanding_units decimal(24,4)",
            (DAY, 3, D("50"), D("5000"), D("100")),
        ),
        "hr.employee": _rows(
            spark, person,
            person_row(11, "Rita", "SALES-W", "BROKER", "E-21"), person_row(12, "Bo", "SALES-E", "BROKER", None),
            person_row(13, "Tim", "SALES-W", "COLLABORATOR", None, "COLLABORATOR", False),
            person_row(21, "Hugo", "SALES-W", "HEAD_OF_DEPARTMENT", "E-22"), person_row(22, "Dora", None, "BRANCH_DIRECTOR", None),
        ),
        "stg_equity__equity_trade": _rows(
            spark,
            "trade_id bigint, trade_date date, trade_datetime timestamp_ntz, source_trade_id string, account_no string, "
            "customer_code string, broker_code string, security_id bigint, market string, side string, order_type string, "
            "quantity decimal(18,0), price decimal(18,2), amount decimal(20,2), fee_amount decimal(18,2), "
            "tax_amount decimal(18,2), settlement_date date, order_id string, source_system string, ingested_at timestamp_ntz",
            equity_trade(1, DAY, "S-501", "ANN", "RED", "BUY", 200, 10, 10),
            equity_trade(2, DAY, "S-601", "ORB", "BLUE", "SELL", 300, 20, 40),
            equity_trade(3, NEXT, "S-502", "ANN", "RED", "SELL", 100, 11, 5),
        ),
        "stg_derivatives__derivative_trade": _rows(
            spark,
            "trade_id bigint, trade_date date, trade_datetime timestamp_ntz, source_trade_id string, account_no string, "
            "customer_code string, broker_code string, contract_id bigint, position_side string, order_action string, "
            "quantity decimal(18,0), price decimal(18,2), amount decimal(20,2), margin_amount decimal(20,2), "
            "fee_amount decimal(18,2), settlement_date date, order_id string, source_system string, ingested_at timestamp_ntz",
            (5, DAY, dt.datetime(2025, 3, 12, 11), "Y5", "F-701", "ORB", "BLUE", 60, "SHORT", "CLOSE", D(3), D(3000), D(9000), D(900), D(30), None, None, "FUTURES", AT),
        ),
        "stg_oef__oef_trade": _rows(
            spark,
            "trade_id bigint, trade_date date, trade_datetime timestamp_ntz, source_trade_id string, account_no string, "
            "customer_code string, broker_code string, fund_id bigint, transaction_type string, quantity_unit decimal(20,4), "
            "nav_price decimal(18,4), amount decimal(20,2), fee_amount decimal(18,2), settlement_date date, order_id string, "
            "source_system string, ingested_at timestamp_ntz",
            (8, DAY, dt.datetime(2025, 3, 12, 12), "Z8", "U-801", "ANN", "RED", 3, "SUBSCRIBE", D(10), D(50), D(500), D(2), None, None, "FUNDS", AT),
        ),
        "stg_equity__account_balance_daily": _rows(
            spark, balance,
            *money(DAY, (501, 400, 600), (502, 100, 300), (601, 500, 1500)), *money(NEXT, (501, 400, 700), (502, 50, 400), (601, 500, 1400)),
        ),
        "stg_derivatives__account_balance_daily": _rows(spark, balance, *money(DAY, (701, 3000, 0)), *money(NEXT, (701, 3000, 0))),
        "stg_oef__account_balance_daily": _rows(spark, balance, *money(DAY, (801, 0, 500)), *money(NEXT, (801, 0, 540))),
        "stg_equity__margin_loan_daily": spark.createDataFrame([], loan),
        "stg_derivatives__margin_loan_daily": _rows(
            spark, loan, (DAY, 701, D(800), D("0.20"), D("0.25"), True), (NEXT, 701, D(700), D("0.40"), D("0.25"), False)
        ),
        "stg_equity__position_daily": _rows(
            spark,
            "position_date date, account_id bigint, security_id bigint, quantity decimal(20,4), avg_cost_price decimal(18,4), market_value decimal(20,2)",
            (NEXT, 501, 91, D(200), D(10), D(700)), (NEXT, 502, 90, D(40), D(10), D(400)),
        ),
        "stg_derivatives__position_daily": _rows(
            spark,
            "position_date date, account_id bigint, contract_id bigint, position_side string, quantity decimal(20,4), avg_cost_price decimal(18,4), market_value decimal(20,2)",
            (NEXT, 701, 60, "SHORT", D(3), D(3000), D(9000)),
        ),
        "stg_oef__position_daily": _rows(
            spark,
            "position_date date, account_id bigint, fund_id bigint, quantity_unit decimal(20,4), avg_cost_nav decimal(18,4), market_value decimal(20,2)",
            (NEXT, 801, 3, D(10), D(50), D(540)),
        ),
    }
