"""Reports over the two invented days, with results worked out by hand."""

import datetime as dt
from decimal import Decimal as D

import pytest
import tiny

import tradewharf.plans  # noqa: F401
from tradewharf.operators.hierarchy import manager_chain
from tradewharf.registry import Lake


@pytest.fixture(scope="module")
def lake(spark):
    return Lake(spark, tiny.sources(spark), tiny.DAY + dt.timedelta(days=5))


def test_commission(lake):
    """A fifth, a tenth and two fifths of the fees."""
    got = {}
    for r in lake["rpt_broker_commission_revenue"].collect():
        key = (r.product_type, r.broker_code)
        got[key] = got.get(key, 0) + r.broker_commission_amount
    assert got == {
        ("EQUITY", "RED"): D(3), ("EQUITY", "BLUE"): D(8), ("DERIVATIVES", "BLUE"): D(3), ("OEF", "RED"): D("0.8")
    }


def test_cross_sell(lake):
    rows = {r.customer_code: r for r in lake["rpt_customer_cross_sell"].collect()}
    assert (rows["ANN"].uses_equity, rows["ANN"].uses_derivatives, rows["ANN"].uses_oef) == (1, 0, 1)
    assert (rows["ORB"].uses_equity, rows["ORB"].uses_derivatives, rows["ORB"].uses_oef) == (1, 1, 0)
    assert not any(r.is_cross_sell_opportunity for r in rows.values())


def test_margin_takes_the_latest_day(lake):
    (row,) = lake["rpt_margin_call_alert"].collect()
    assert row.account_no == "F-701" and row.needs_attention is False


def test_fund_flow(lake):
    (row,) = lake["rpt_oef_fund_flow"].collect()
    assert (row.subscribe_amount, row.redeem_amount, row.net_flow_amount) == (D(500), D(0), D(500))
    assert row.nav_price == D(50)


def test_override_only_units_with_a_manager(lake):
    """Fees of 17 in the west: 4 % for its head, 2 % for its director; the east has neither."""
    got = {r.management_level: r for r in lake["rpt_management_override_commission"].collect()}
    assert got["HEAD_OF_DEPARTMENT"].override_commission_amount == D("0.68")
    assert got["BRANCH_DIRECTOR"].override_commission_amount == D("0.34")
    assert got["HEAD_OF_DEPARTMENT"].employee_name == "Hugo" and len(got) == 2


def test_aum_all_attributed(lake):
    rows = lake["rpt_aum_summary"].collect()
    assert rows and all(r.broker_code for r in rows)


def test_performance_over_two_days(lake):
    """Ann's three accounts go from 1900 to 2090, Orb's two from 5000 to 4900, the index up 2 %."""
    rows = {r.customer_code: r for r in lake["rpt_customer_investment_performance"].collect()}
    assert rows["ANN"].start_value == D(1900) and abs(rows["ANN"].customer_return_pct - 0.1) < 1e-9
    assert rows["ORB"].start_value == D(5000) and abs(rows["ORB"].customer_return_pct + 0.02) < 1e-9
    assert all(abs(r.vnindex_return_pct - 0.02) < 1e-9 for r in rows.values())


def test_dormant_and_boundary(spark):
    """Orb traded last on the first day, Ann on the second."""
    for days, orb, ann in ((89, False, False), (90, True, False), (91, True, True)):
        at = Lake(spark, tiny.sources(spark), tiny.DAY + dt.timedelta(days=days))
        got = {r.customer_code: r.is_dormant for r in at["rpt_customer_dormant"].collect()}
        assert got == {"ORB": orb, "ANN": ann}


def test_broker_without_customers_has_null_ratios(lake):
    rows = {r.broker_code: r for r in lake["rpt_broker_performance"].collect()}
    assert rows["TAN"].managed_customer_count == 0
    assert rows["TAN"].retention_ratio_90d is None and rows["TAN"].total_trade_amount == 0
    assert rows["RED"].retention_ratio_90d == 1.0


def test_broker_dimension_matches_registry_by_identity(lake):
    rows = {r.broker_code: r for r in lake["dim_broker"].collect()}
    assert rows["TAN"].position_level == "COLLABORATOR"
    assert "id_number" not in lake["dim_broker_public"].columns


def test_customer_identity_number_is_dropped(lake):
    assert "id_number" not in lake["stg_common__customer"].columns
    assert "id_number" not in lake["dim_customer"].columns


def test_manager_chain(lake):
    pairs = manager_chain(lake["hr.employee"]).collect()
    got = sorted((r.id_number, r.chain_level, r.manager_employee_code) for r in pairs)
    assert got == [("P11", 1, "E-21"), ("P11", 2, "E-22"), ("P21", 1, "E-22")]


def test_concentration_shares_add_up(lake):
    rows = lake["rpt_position_concentration_risk"].collect()
    total = {}
    for r in rows:
        total[r.customer_code] = total.get(r.customer_code, 0) + r.pct_of_customer_portfolio
    assert all(abs(v - 1) < 1e-9 for v in total.values())


def test_concentration_totals(spark, capsys):
    """Plain Python gives the same totals, with repeated rows and NULLs; the positions are read
    for the rows and for the instruments' totals, not once more for the customers'."""
    accounts = [("EQUITY", 1, "A"), ("EQUITY", 2, "A"), ("OEF", 1, "B"), ("OEF", 3, None), ("EQUITY", 4, "B"), ("EQUITY", 4, "C"), (None, 1, "A")]
    positions = [
        (product, account, instrument, day, value)
        for product in ("EQUITY", "OEF", None) for account in (1, 2, 3, 4, 5, None) for instrument in (7, None)
        for day in (dt.date(2020, 1, 1), dt.date(2020, 1, 2), None) for value in (D("10"), D("10"), D("2.5"), None)
    ]
    given = {
        "fact_position_daily": spark.createDataFrame(
            positions, "product_type string, account_id bigint, instrument_id bigint, position_date date, market_value decimal(20,2)"
        ),
        "dim_account": spark.createDataFrame(accounts, "product_type string, account_id bigint, customer_code string"),
    }
    owned = [
        (day, product, instrument, who, value)
        for product, account, instrument, day, value in positions if day and product and account
        for p, a, who in accounts if who and (p, a) == (product, account)
    ]

    def total(place, key):
        values = [r[4] for r in owned if tuple(r[i] for i in place) == key and r[4] is not None]
        return sum(values) if values else None

    want = [(*r, total((3, 0), (r[3], r[0])), total((0, 1, 2), r[:3])) for r in owned]
    out = Lake(spark, given)["rpt_position_concentration_risk"]
    cols = [
        "position_date", "product_type", "instrument_id", "customer_code", "market_value",
        "customer_total_market_value", "firm_wide_market_value_in_instrument",
    ]

    def plain(rows):
        return sorted(str(tuple(float(x) if isinstance(x, D) else x for x in r)) for r in rows)

    assert plain(out.select(cols).collect()) == plain(want)
    out.explain()
    scans = [line for line in capsys.readouterr().out.splitlines() if "Scan" in line and "market_value" in line]
    assert len(scans) == 2


def test_unknown_table(lake):
    with pytest.raises(KeyError, match="no_such_table"):
        lake["no_such_table"]


def test_missing_column_is_named(spark):
    bad = {"common.branch": spark.range(1)}
    with pytest.raises(ValueError, match="branch_code"):
        Lake(spark, bad)["stg_common__branch"]
