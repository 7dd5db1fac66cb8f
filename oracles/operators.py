"""Expected results of the operator queries."""

from __future__ import annotations

from oracles.domain import code
from oracles.models import CALENDAR, MODEL_SQL, ratio

CUT = "date '1999-01-01'"
DAYS = "cast(unnest(generate_series({a}, {b} - 1, interval 1 day)) as date)"
FIXED = "case when trade_id % 50 = 0 then cast(amount + 1 as decimal(20,2)) else amount end"
POSITION_KEYS = "product_type, account_id, instrument_id, position_date, market_value"

# Three states of the customer profile, as captured on 1, 2 and 3 January 2002.
STATES = """base as (select *, cast(substr(customer_code, 3) as bigint) % 10 as k from m_customer),
s1 as (select * replace (case when k = 6 then null else current_segment end as current_segment) from base where k <> 4),
s2 as (select * replace (case when k = 1 then 'MG-CHANGED' else current_broker_code end as current_broker_code,
    case when k = 2 then not is_active else is_active end as is_active,
    case when k = 5 then 'renamed' else customer_name end as customer_name) from base where k <> 3),
s3 as (select * replace (case when k = 2 then not is_active else is_active end as is_active,
    case when k = 5 then 'renamed' else customer_name end as customer_name) from base),
states as (select *, timestamp '2002-01-01 00:00:00' as cap from s1 union all select *, timestamp '2002-01-02 00:00:00' from s2
  union all select *, timestamp '2002-01-03 00:00:00' from s3),
marked as (select *, lag(cap) over w as prev_at,
    lag(cap) over w is null or lag(current_broker_code) over w is distinct from current_broker_code
      or lag(current_segment) over w is distinct from current_segment
      or lag(current_risk_level) over w is distinct from current_risk_level
      or lag(investor_classification) over w is distinct from investor_classification
      or lag(is_active) over w is distinct from is_active as opens
  from states window w as (partition by customer_code order by cap)),
versions as (select * exclude (k, prev_at, opens), cap as valid_from,
    lead(cap) over (partition by customer_code order by cap) as valid_to from marked where opens)"""

CHANGES = f"""ch as (
  select {code('KH', 'c_custkey')} as customer_code, 1 as seq, date '2010-01-01' + cast(c_custkey % 100 as integer) as effective_date, 'MG-A' as broker_code from customer
  union all select {code('KH', 'c_custkey')}, 2, date '2020-06-01', 'MG-B' from customer where c_custkey % 2 = 1
  union all select {code('KH', 'c_custkey')}, 3, date '1990-01-01', 'MG-C' from customer where c_custkey % 5 = 0
  union all select {code('KH', 'c_custkey')}, 4, date '2010-01-01' + cast(c_custkey % 100 as integer), 'MG-D' from customer where c_custkey % 4 = 0),
judged as (select ch.*, row_number() over (partition by ch.customer_code, effective_date order by seq) = 1
    and (h.valid_from is null or effective_date > h.valid_from) as ok
  from ch left join d_cbh h on h.customer_code = ch.customer_code and h.is_current)"""


def changed(history: str, attrs: str, first: str, second: str) -> str:
    """A history after one change per customer in 2010 and one in 2020 for odd keys; those of
    1990 lie before the open version and are refused."""
    return f"""with ch as (
  select {code('KH', 'c_custkey')} as customer_code, date '2010-01-01' + cast(c_custkey % 100 as integer) as starts, {first}, c_custkey % 2 = 1 as odd from customer)
select h.customer_code, {attrs}, h.valid_from, if(h.is_current, (select starts - 1 from ch where ch.customer_code = h.customer_code), h.valid_to) as valid_to,
  false as is_current from {history} h
union all select customer_code, {attrs}, starts, if(odd, date '2020-05-31', null), not odd from ch
union all select customer_code, {second}, date '2020-06-01', null, true from ch where odd"""


def union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


def entry(table: str, check: str, column: str, observed: str, status: str | None = None) -> str:
    """One report row. The default status passes when nothing was found."""
    status = status or "case when o = 0 then 'pass' else 'fail' end"
    return (
        f"select '{table}' as table_name, '{check}' as check_name, '{column}' as column_name, "
        f"cast(o as bigint) as observed, {status} as status from ({observed})"
    )


# Where each checked table comes from.
TABLES = {
    "dim_broker": "m_broker",
    "dim_customer": "m_customer",
    "dim_account": "m_account",
    "dim_security": "d_security",
    "dim_branch": "m_branch",
    "dim_department": "m_department",
    "dim_derivative_contract": "d_contract",
    "dim_fund": "d_fund",
    "dim_date": f"({CALENDAR})",
    "fact_equity_trade": "s_equity_trade",
    "fact_derivative_trade": "s_derivative_trade",
    "fact_oef_trade": "s_oef_trade",
    "rpt_broker_commission_revenue": "m_commission",
    "rpt_aum_summary": "m_aum",
    "rpt_margin_call_alert": "(select * from m_margin_report where loan_date = (select max(loan_date) from m_margin))",
    "int_all_trades": "m_trades",
}
FRESH_SOURCES = {
    "branch": "d_branch", "broker": "d_broker", "customer": "d_customer", "customer_acquisition": "d_acquisition",
    "customer_broker_history": "d_cbh", "customer_complaint": "d_complaint", "customer_risk_profile": "d_risk",
    "customer_segment_history": "d_segment", "department": "d_department", "trading_alert": "d_alert",
}
TABLES.update({f"stg_common__{t}": src for t, src in FRESH_SOURCES.items()})
# Reports whose statement has its own WITH clause are counted through it.
REPORTS = [
    ("rpt_trading_activity_summary", "trade_month"),
    ("rpt_customer_acquisition_funnel", "acquisition_channel"),
    ("rpt_customer_dormant", "customer_code"),
    ("rpt_position_concentration_risk", "instrument_id"),
    ("rpt_oef_fund_flow", "fund_code"),
    ("rpt_customer_investment_performance", "customer_code"),
    ("rpt_customer_cross_sell", "customer_code"),
    ("rpt_management_override_commission", "employee_code"),
    ("rpt_department_branch_ranking", "branch_id"),
    ("rpt_broker_performance", "broker_code"),
]


def source(table: str) -> str:
    return TABLES.get(table) or f"({MODEL_SQL[table]})"


# The checks of the gold layer.
MISSING = {
    "dim_broker": "broker_code", "dim_customer": "customer_code customer_type", "dim_account": "account_id",
    "dim_security": "security_id", "dim_branch": "branch_id branch_code",
    "dim_department": "department_id department_code", "dim_derivative_contract": "contract_id contract_code",
    "dim_fund": "fund_id fund_code", "dim_date": "date_key",
    "fact_equity_trade": "trade_id source_trade_id quantity amount",
    "fact_derivative_trade": "trade_id source_trade_id", "fact_oef_trade": "trade_id source_trade_id",
    "rpt_broker_commission_revenue": "broker_code", "rpt_aum_summary": "customer_code",
    "rpt_margin_call_alert": "account_id", **{t: c for t, c in REPORTS},
}
UNIQUE = {
    "dim_broker": "broker_code", "dim_customer": "customer_code", "dim_security": "security_id",
    "dim_branch": "branch_id", "dim_department": "department_id", "dim_derivative_contract": "contract_id",
    "dim_fund": "fund_id", "dim_date": "date_key", "fact_equity_trade": "trade_id source_trade_id",
    "fact_derivative_trade": "trade_id source_trade_id", "fact_oef_trade": "trade_id source_trade_id",
}
ACCEPTED = [
    ("dim_broker", "broker_type", "'BROKER', 'COLLABORATOR'"),
    ("dim_customer", "customer_type", "'INDIVIDUAL', 'ORGANIZATION', 'PROPRIETARY'"),
    ("dim_customer", "residency", "'DOMESTIC', 'FOREIGN'"),
    ("fact_equity_trade", "side", "'BUY', 'SELL'"),
    ("fact_derivative_trade", "position_side", "'LONG', 'SHORT'"),
    ("fact_oef_trade", "transaction_type", "'SUBSCRIBE', 'REDEEM', 'SWITCH'"),
]
PARENTS = [
    ("fact_equity_trade", "customer_code", "d_customer", "customer_code"),
    ("fact_equity_trade", "security_id", "d_security", "security_id"),
    ("fact_derivative_trade", "contract_id", "d_contract", "contract_id"),
    ("fact_oef_trade", "fund_id", "d_fund", "fund_id"),
]
FACTS = ("fact_equity_trade", "fact_derivative_trade", "fact_oef_trade")


def missing(t: str, c: str) -> str:
    return entry(t, "missing", c, f"select count(*) as o from {source(t)} where {c} is null")


def row_count(t: str) -> str:
    return entry(t, "row_count", "", f"select count(*) as o from {source(t)}", "case when o > 0 then 'pass' else 'fail' end")


def duplicates(t: str, cols: str, where: str | None = None, src: str | None = None) -> str:
    cond = where or " and ".join(f"{c} is not null" for c in cols.split(","))
    return entry(
        t, "duplicates", cols,
        f"select count(*) as o from (select {cols} from {src or source(t)} where {cond} group by {cols} having count(*) > 1)",
    )


def accepted(t: str, c: str, values: str, check: str = "accepted_values") -> str:
    return entry(t, check, c, f"select count(*) as o from {source(t)} where {c} not in ({values})")


def orphaned(t: str, c: str, parent: str, pk: str) -> str:
    return entry(
        t, "orphans", c,
        f"select count(*) as o from {source(t)} x where {c} is not null and not exists (select 1 from {parent} p where p.{pk} = x.{c})",
    )


def non_negative(t: str, c: str) -> str:
    return entry(t, "non_negative", c, f"select count(*) as o from {source(t)} where {c} < 0")


def freshness(t: str, now: str = "2001-08-03 12:00:00", warn: int = 24, fail: int = 24) -> str:
    return entry(
        t, "freshness", "ingested_at",
        f"select date_sub('hour', max(ingested_at), timestamp '{now}') as o from {source(t)}",
        f"case when o >= {fail} then 'fail' when o >= {warn} then 'warn' else 'pass' end",
    )


def anomalies(t: str) -> str:
    return f"""select d as day, n as row_count, round(avg(n) over w, 6) as trailing_mean, round(stddev_samp(n) over w, 6) as trailing_stddev,
    count(*) over w >= 2 and abs(n - avg(n) over w) > stddev_samp(n) over w * (2 / 0.7) as is_anomaly, '{t}' as table_name
  from (select trade_date as d, count(*) as n from {source(t)} group by 1)
  window w as (order by d rows between 7 preceding and 1 preceding)"""


def anomaly(t: str) -> str:
    return entry(t, "anomaly", "trade_date", f"select count(*) as o from ({anomalies(t)}) where is_anomaly")


def constraint(t: str, src: str, name: str, expr: str) -> str:
    return entry(t, name, "", f"select count(*) as o from {src} where not ({expr})")


ALL_MISSING = [missing(t, c) for t, cols in MISSING.items() for c in cols.split()]
ALL_DUPLICATES = [duplicates(t, c) for t, cols in UNIQUE.items() for c in cols.split()]
ALL_COMBOS = [duplicates("dim_account", "product_type,account_id")]
ALL_ACCEPTED = [accepted(*a) for a in ACCEPTED]
ALL_ORPHANS = [orphaned(*a) for a in PARENTS]
ALL_ROWS = [row_count(t) for t in MISSING]
ALL_BOUNDS = [
    non_negative("rpt_broker_commission_revenue", "broker_commission_amount"),
    non_negative("rpt_aum_summary", "total_asset_value"),
    non_negative("rpt_margin_call_alert", "margin_ratio"),
]
ALL_FRESH = [freshness(t) for t in FACTS]
ALL_ANOMALIES = [anomaly(t) for t in FACTS]

PERIOD = "valid_to is null or valid_to >= valid_from"
CONSTRAINTS = [
    ("stg_common__broker", "d_broker", "broker_type", "broker_type in ('BROKER', 'COLLABORATOR')"),
    ("stg_common__broker", "d_broker", "employee_code_for_broker", "broker_type <> 'BROKER' or employee_code is not null"),
    ("stg_common__broker", "d_broker", "broker_subtype", "(broker_type = 'BROKER' and broker_subtype in ('STANDARD', 'SENIOR', 'TEAM_LEAD', 'RM_VIP')) or (broker_type = 'COLLABORATOR' and broker_subtype in ('REFERRAL_INDIVIDUAL', 'REFERRAL_AFFILIATE', 'REFERRAL_INSTITUTIONAL'))"),
    ("stg_common__customer", "d_customer", "customer_type", "customer_type in ('INDIVIDUAL', 'ORGANIZATION', 'PROPRIETARY')"),
    ("stg_common__customer", "d_customer", "residency", "residency in ('DOMESTIC', 'FOREIGN')"),
    ("stg_common__customer", "d_customer", "proprietary_residency", "customer_type <> 'PROPRIETARY' or residency = 'DOMESTIC'"),
    ("stg_common__customer_broker_history", "d_cbh", "dates", PERIOD),
    ("stg_common__customer_risk_profile", "d_risk", "classification", "investor_classification in ('PROFESSIONAL', 'NON_PROFESSIONAL')"),
    ("stg_common__customer_risk_profile", "d_risk", "risk_level", "risk_level in ('LOW', 'MEDIUM', 'HIGH')"),
    ("stg_common__customer_risk_profile", "d_risk", "dates", PERIOD),
    ("stg_common__customer_segment_history", "d_segment", "segment", "segment in ('VIP', 'PRIORITY', 'RETAIL')"),
    ("stg_common__customer_segment_history", "d_segment", "dates", PERIOD),
    ("stg_common__fee_schedule", "d_fee", "product_type", "product_type in ('EQUITY', 'DERIVATIVES', 'OEF')"),
    ("stg_common__management_commission_schedule", "d_mgmt", "management_level", "management_level in ('HEAD_OF_DEPARTMENT', 'BRANCH_DIRECTOR')"),
    ("stg_common__trading_alert", "d_alert", "severity", "severity in ('LOW', 'MEDIUM', 'HIGH')"),
    ("stg_common__trading_alert", "d_alert", "status", "status in ('OPEN', 'REVIEWING', 'CLOSED', 'ESCALATED')"),
    ("stg_common__customer_complaint", "d_complaint", "status", "status in ('OPEN', 'IN_PROGRESS', 'RESOLVED', 'CLOSED')"),
    ("fact_equity_trade", "s_equity_trade", "side", "side in ('BUY', 'SELL')"),
    ("fact_derivative_trade", "s_derivative_trade", "position_side", "position_side in ('LONG', 'SHORT')"),
    ("fact_derivative_trade", "s_derivative_trade", "order_action", "order_action in ('OPEN', 'CLOSE')"),
    ("fact_oef_trade", "s_oef_trade", "transaction_type", "transaction_type in ('SUBSCRIBE', 'REDEEM', 'SWITCH')"),
    ("stg_derivatives__position_daily", "s_derivatives_position", "position_side", "position_side in ('LONG', 'SHORT')"),
    ("stg_common__fee_schedule", "d_fee", "effective_dates", "effective_to is null or effective_to >= effective_from"),
]
UNIQUE_WHERE = [
    duplicates("stg_common__broker", "id_number", "id_number is not null", "d_broker"),
    duplicates("stg_common__customer_broker_history", "customer_code", "is_current", "d_cbh"),
    duplicates("stg_common__customer_risk_profile", "customer_code", "is_current", "d_risk"),
    duplicates("stg_common__customer_segment_history", "customer_code", "is_current", "d_segment"),
    duplicates("stg_common__fee_schedule", "product_type,broker_tier", "is_current", "d_fee"),
    duplicates("stg_common__management_commission_schedule", "management_level", "is_current", "d_mgmt"),
]

CHAIN = """WITH RECURSIVE chain(id_number, manager_id_number, manager_employee_code, chain_level, next_code, path) as (
  select e.id_number, m.id_number, m.employee_code, 1, m.manager_employee_code, [e.id_number, m.id_number]
  from d_employee e join d_employee m on m.employee_code = e.manager_employee_code and m.id_number <> e.id_number
  union all
  select c.id_number, m.id_number, m.employee_code, c.chain_level + 1, m.manager_employee_code, list_append(c.path, m.id_number)
  from chain c join d_employee m on m.employee_code = c.next_code where not list_contains(c.path, m.id_number))"""

OPERATOR_SQL: dict[str, str] = {
    # sources and sinks
    "export_partition": """select o_orderkey, o_custkey, cast(o_totalprice as decimal(20,2)) as total,
  cast(date_trunc('month', o_orderdate) as date) as dt from orders""",
    "export_partition_rerun": "select event_id, user_id, cast(ts as date) as dt from events",
    "land_variant": """select o_orderkey, o_custkey, cast(o_totalprice as decimal(20,2)) as o_totalprice, o_orderdate, o_orderpriority,
  timestamp '2030-01-01 00:00:00' as _loaded_at, 'orders.parquet' as _file_name from orders""",
    "stream_ingest": """select event_id, user_id, event_type, cast(value as decimal(20,2)) as value, ts,
  timestamp '2030-01-01 00:00:00' as _loaded_at from events""",
    "backfill_idempotent": f"""select o_orderkey, 'orders/dt=' || strftime(o_orderdate, '%Y-%m-01') || '/part-0000.parquet' as _file_name,
  case when o_orderdate < {CUT} then 1 else 2 end as load_no from orders""",
    "backfill_changed_files": f"""with o as (select o_orderkey, cast(o_totalprice as decimal(20,2)) as total, o_orderdate < {CUT} as early,
    'orders/dt=' || strftime(o_orderdate, '%Y-%m-%d') as _file_name, o_orderkey % 50 = 0 as fixed from orders)
select o_orderkey, total, _file_name, 1 as load_no from o where early
union all select o_orderkey, cast(if(fixed, total + 1, total) as decimal(20,2)), _file_name, 2 from o
where not early or _file_name < 'orders/dt=1993' or _file_name in (select _file_name from o where fixed)""",
    "parse_json_props": "select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events",
    "full_refresh_dim": "select broker_code, broker_name, is_active from d_broker",
    "lake_partitioned_write": "select event_id, cast(value as decimal(20,2)) as value, cast(ts as date) as execution_date from events",
    "hr_employees": "select * from d_employee",
    "hr_filter": "select id_number, employee_code, status, person_type from d_employee where status = 'ACTIVE' and person_type = 'EMPLOYEE'",
    "hr_lookup": "select id_number, full_name, status from d_employee where id_number = '09000000000001'",
    "verify_landing_profile": union(
        [
            f"""select '{p}' as product_type, count(*) as row_count, count(distinct source_trade_id) as distinct_keys,
  min(trade_date) as min_date, max(trade_date) as max_date from {src} where source_system like '%E_%'"""
            for p, src in (("EQUITY", "l_equity_trade"), ("DERIVATIVES", "l_derivative_trade"), ("OEF", "l_oef_trade"))
        ]
    ),
    "reconcile_counts": """select coalesce(s.d, t.d) as day, coalesce(s.n, 0) as source_count, coalesce(t.n, 0) as target_count,
  coalesce(s.n, 0) = coalesce(t.n, 0) as is_equal
from (select trade_date as d, count(*) as n from l_equity_trade group by 1) s
full join (select trade_date as d, count(*) as n from s_equity_trade group by 1) t on t.d = s.d""",
    "reconcile_content": """with s as (select source_system as sys, source_trade_id as id, trade_id as k, trade_date as d, amount as a from s_equity_trade),
c as (select sys, id, k, case when k % 103 = 9 then d + 1 else d end as d, case when k % 101 = 7 then a + 1 else a end as a from s where k % 97 <> 5
  union all select sys, 'NEW-' || id, k, d, a from s where k % 107 = 11)
select ifnull(s.d, c.d) as day, ifnull(s.sys, c.sys) as source_system, ifnull(s.id, c.id) as source_trade_id,
  case when c.id is null then 'missing' when s.id is null then 'extra' else 'changed' end as state
from s full join c on (s.d, s.sys, s.id) = (c.d, c.sys, c.id) where s.id is null or c.id is null or s.a <> c.a""",
    # projections and predicates
    "stg_customer_no_pii": "select customer_code, customer_name, phone, email from d_customer",
    "star_except": """select * exclude (_loaded_at) from l_equity_trade
qualify row_number() over (partition by source_system, source_trade_id order by _loaded_at desc) = 1""",
    "flatten_variant": """select *, 'margin_loan_daily/part-000' || case when _loaded_at = timestamp '2030-01-01 00:00:00' then '0' else '1' end || '.parquet' as _file_name
from l_equity_margin""",
    "quarantine_bad_casts": """select source_trade_id, case when trade_id % 50 = 1 then null else contract_id end as contract_id,
  case when trade_id % 50 = 1 then 'contract_id' else '' end as bad_fields from s_derivative_trade""",
    "filter_current": "select history_id, customer_code, broker_code, valid_from, valid_to, is_current from d_cbh where is_current",
    "filter_equality": "select price_date, close_value from d_index where index_code = 'VNINDEX'",
    "flag_case": """select product_type, account_id, loan_date, case when call_margin_flag then true
  when margin_ratio < maintenance_margin_ratio then true else false end as needs_attention from m_margin""",
    "latest_date_slice": "select * from m_margin where loan_date = (select max(loan_date) from m_margin)",
    "pit_join": """select t.product_type, t.trade_id, t.trade_date, t.customer_code, h.broker_code as holder_code, h.valid_from
from m_trades t left join d_cbh h on h.customer_code = t.customer_code and t.trade_date >= h.valid_from
  and (h.valid_to is null or t.trade_date <= h.valid_to)""",
    "asof_join": """select product_type, trade_id, trade_date, t.customer_code, holder_code, valid_from
from m_trades t left join lateral (select h.broker_code as holder_code, h.valid_from from d_cbh h
  where h.customer_code = t.customer_code and t.trade_date between h.valid_from and ifnull(h.valid_to, date '9999-12-31')) on true""",
    "rate_lookup": """select t.product_type, t.trade_id, t.trade_date, f.fee_rate, f.commission_rate
from m_trades t left join d_fee f on f.product_type = t.product_type and t.trade_date >= f.effective_from
  and (f.effective_to is null or t.trade_date <= f.effective_to)""",
    "rate_lookup_tiered": """select t.product_type, t.trade_id, b.broker_subtype as tier,
  cast(f.commission_rate + case when b.broker_subtype = 'SENIOR' then 0.1 else 0 end as decimal(9,6)) as commission_rate
from m_trades t join m_broker b on b.broker_code = t.broker_code
left join d_fee f on f.product_type = t.product_type and t.trade_date >= f.effective_from
  and (f.effective_to is null or t.trade_date <= f.effective_to)""",
    "month_partition_counts": """select product_type, cast(date_trunc('month', trade_date) as date) as trade_month, count(*) as row_count
from m_trades group by 1, 2""",
    # joins
    "join_inner": "select t.product_type, t.trade_id, t.broker_code, b.department_name from m_trades t join m_broker b on b.broker_code = t.broker_code",
    "join_composite": """select f.product_type, f.account_id, f.balance_date, a.customer_code
from m_balance f join m_account a on a.product_type = f.product_type and a.account_id = f.account_id""",
    "join_left": """select c.customer_code, c.current_broker_code, b.broker_name
from m_customer c left join m_broker b on b.broker_code = c.current_broker_code""",
    "snapshot_grid": f"""with b as (select cast(min(ts) as date) as a, cast(max(ts) as date) + 1 as z from events),
days as (select {DAYS.format(a='a', b='z')} as d from b)
select product_type, account_id, d as snapshot_date from m_account cross join days where isodow(d) <= 5""",
    "mark_to_market": """select h.account_id, h.security_id, h.position_date, p.close_price,
  cast(round(h.quantity * coalesce(cast(p.close_price as decimal(18,4)), h.avg_cost_price), 2) as decimal(20,2)) as market_value
from s_equity_position h left join d_price p on p.security_id = h.security_id and p.price_date = h.position_date""",
    "price_calendar_join": f"""with c as (select contract_id, {DAYS.format(a='listing_date', b='(maturity_date + 1)')} as d from d_contract)
select c.contract_id, c.d as price_date, s.settlement_price from c
left join d_settlement s on s.contract_id = c.contract_id and s.price_date = c.d where isodow(c.d) <= 5""",
    "share_of_total": f"""select {POSITION_KEYS}, sum(market_value) over w as day_value,
  round(cast(market_value as double) / nullif(cast(sum(market_value) over w as double), 0), 6) as share
from m_position window w as (partition by account_id, position_date)""",
    "window_total": f"""select {POSITION_KEYS}, sum(market_value) over (partition by position_date, product_type, instrument_id) as firm_value
from m_position""",
    "orphans_trade_broker": """select product_type, trade_id, broker_code from m_trades
where broker_code is not null and broker_code not in (select broker_code from d_broker)""",
    "orphans_position_account": """select account_id, security_id, position_date from s_equity_position
where account_id not in (select account_id from d_equity_account)""",
    "manager_chain": CHAIN + "\nselect id_number, manager_id_number, manager_employee_code, chain_level from chain",
    "manager_chain_revenue": CHAIN
    + """
select c.manager_id_number, sum(r.fee) as subtree_revenue, count(*) as subordinate_count from chain c
join (select b.id_number, sum(t.fee_amount) as fee from m_trades t join d_broker b on b.broker_code = t.broker_code group by 1) r
  on r.id_number = c.id_number group by 1""",
    # aggregations
    "agg_sum": """select product_type, cast(year(trade_date) as integer) as trade_year, sum(amount) as amount, sum(fee_amount) as fee_amount
from m_trades group by 1, 2""",
    "agg_multi_distinct": """select product_type, cast(date_trunc('month', trade_date) as date) as month, count(distinct trade_id) as trades,
  count(distinct customer_code) as customers, count(distinct broker_code) as brokers from m_trades group by 1, 2""",
    "agg_cond_distinct": """select broker_code, count(distinct customer_code) as customers,
  count(distinct case when amount >= 250000 then customer_code end) as big_customers from m_trades group by 1""",
    "agg_cond_sum": """select security_id, sum(case when side = 'BUY' then amount else 0 end) as bought,
  sum(case when side = 'SELL' then amount else 0 end) as sold, sum(case when side = 'BUY' then amount else -amount end) as net
from s_equity_trade group by 1""",
    "agg_flags": """select customer_code, max(case when product_type = 'EQUITY' then 1 else 0 end) as uses_equity,
  max(case when product_type = 'OEF' then 1 else 0 end) as uses_oef from m_trades group by 1""",
    "agg_first_last_date": "select customer_code, min(trade_date) as first_trade, max(trade_date) as last_trade from m_trades group by 1",
    "agg_open_close": """select security_id, cast(year(price_date) as integer) as year, cast(quarter(price_date) as integer) as quarter,
  arg_min(close_price, price_date) as open, arg_max(close_price, price_date) as close from d_price group by 1, 2, 3""",
    "agg_ratio": f"""select product_type, broker_code, {ratio('sum(fee_amount)', 'sum(amount)')} as fee_share,
  cast(null as double) as no_divisor from m_trades group by 1, 2""",
    "select_distinct": "select distinct account_no, customer_code, broker_code from m_trades",
    # windows, order, limits
    "dedup_latest": """select l_orderkey, l_partkey, l_suppkey, l_linenumber, cast(l_quantity as decimal(20,2)) as l_quantity,
  cast(l_extendedprice as decimal(20,2)) as l_extendedprice, cast(l_discount as decimal(20,2)) as l_discount,
  cast(l_tax as decimal(20,2)) as l_tax, l_returnflag, l_linestatus, l_shipdate
from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_extendedprice desc,
  l_partkey desc, l_suppkey desc, l_quantity desc, l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc) = 1""",
    "cumulative_ranges": """select customer_code, w as weight, cast(sum(w) over o as bigint) as range_end,
  cast(sum(w) over o - w + 1 as bigint) as range_start
from (select customer_code, case current_segment when 'VIP' then 8 when 'PRIORITY' then 3 else 1 end as w from m_customer)
window o as (order by customer_code rows unbounded preceding)""",
    "weighted_allocation": f"""with r as (select broker_code, sum(w) over o as z, sum(w) over o - w + 1 as a
  from (select {code('MG', 's_suppkey')} as broker_code, s_suppkey % 15 + 1 as w from supplier)
  window o as (order by broker_code rows unbounded preceding)),
d as (select {code('KH', 'c_custkey')} as customer_code,
  cast((c_custkey * 7919 + 11) % (select max(z) from r) + 1 as bigint) as draw from customer)
select customer_code, draw, broker_code from d join r on draw between a and z""",
    "top_n_per_row": """with s as (select security_id, row_number() over (order by security_id) - 1 as pos, count(*) over () as total from d_security),
a as (select account_id, account_id % 6 + 3 as n from d_equity_account),
ranked as (select account_id, security_id, n, row_number() over (partition by account_id
    order by (pos - (account_id * 37) % total + total) % total) as pick from a cross join s)
select account_id, security_id, pick from ranked where pick <= n""",
    "trading_day_ordinal": f"""select d as trading_day, cast(row_number() over (partition by date_trunc('month', d) order by d) as integer) as rn
from (select {DAYS.format(a='start_date', b='end_date')} as d from d_bounds) where isodow(d) <= 5""",
    "weight_by_rank": """select security_id, sector, case when row_number() over (partition by sector order by security_id) <= 6 then 15 else 1 end as weight
from d_security""",
    "front_month_weights": """select contract_id, maturity_date, case when rn = 1 then 15 when rn = 2 then 4 else 1 end as weight
from (select contract_id, maturity_date, row_number() over (order by maturity_date, contract_id) as rn
  from d_contract where maturity_date >= date '1998-01-01')""",
    "number_spine": """select n, (select count(*) from orders where o_orderkey = n) as order_count
from (select unnest(range(1, (select count(*) + 1 from orders))) as n)""",
    "open_accounts": """select c.customer_code, h.broker_code, c.open_date from d_customer c
join d_cbh h on h.customer_code = c.customer_code and h.is_current where c.customer_type <> 'PROPRIETARY'""",
    "account_numbering": """select customer_code, rn as account_seq, '0001' || lpad(cast(rn as varchar), 6, '0') as account_no
from (select customer_code, row_number() over (order by customer_code) as rn from d_customer where customer_type <> 'PROPRIETARY')""",
    "base_price": """select s.security_id, s.sector, cast(r.lo + (s.security_id * 37) % nullif(r.hi - r.lo, 0) as decimal(18,2)) as base_price
from d_security s join (select p_type, min(p_size) as lo, max(p_size) as hi from part group by 1) r on r.p_type = s.sector""",
    "top_k": "select product_type, trade_id, amount from m_trades order by amount desc, product_type, trade_id limit 100",
    "sample_n": "select c_custkey from customer order by md5('7/' || c_custkey) limit 800",
    "sample_per_nation": """select c_custkey, c_nationkey from customer
qualify row_number() over (partition by c_nationkey order by md5('7/' || c_custkey)) <= 5""",
    "first_by_key": "select broker_subtype, min(broker_code) as first_broker from d_broker group by 1",
    "ensure_class_present": """select broker_code, broker_subtype,
  case when broker_code = (select min(broker_code) from d_broker where broker_type = 'BROKER') then 'DESK_HEAD' else broker_subtype end as promoted
from d_broker""",
    "history_timeline": """select customer_code, broker_code, valid_from,
  row_number() over (partition by customer_code order by valid_from) as version_no from d_cbh""",
    "union_all": union(
        [
            f"select '{p}' as product_type, source_trade_id, amount from {s}"
            for p, s in (("EQUITY", "s_equity_trade"), ("DERIVATIVES", "s_derivative_trade"), ("OEF", "s_oef_trade"))
        ]
    ),
    "scalar_functions": f"""select o_orderkey, cast(year(d) as integer) as y, cast(quarter(d) as integer) as q, cast(month(d) as integer) as m,
  strftime(d, '%b') as month_name, strftime(d, '%a') as day_name, cast(weekofyear(d) as integer) as week,
  cast(dayofweek(d) as integer) as dow, dayofweek(d) in (0, 6) as weekend, isodow(d) <= 5 as trading_day, d - 90 as minus_90,
  cast(d + interval 1 month as date) as plus_month, last_day(d) as month_end, cast(date_trunc('month', d) as date) as month_first,
  cast(date_diff('day', d, date '2002-01-01') as integer) as days_left, strftime(d, '%Y%m') as yyyymm, strftime(d, '%y%m') as yymm,
  make_date(year(d), month(d), 1) as from_parts, {code('KH', 'o_orderkey')} as code, chr(cast(65 + o_orderkey % 26 as integer)) as letter,
  upper(o_orderpriority) as upper_trim, coalesce(nullif(o_orderkey % 3, 0), -1) as nullif_coalesce,
  cast(round(p * cast(0.0015 as decimal(9,4)), 2) as decimal(20,2)) as rounded, {ratio('p', 'o_orderkey % 5')} as ratio,
  try_cast(o_orderpriority as integer) as bad_cast, o_orderdate + interval 570 minute as opening
from (select *, cast(o_orderdate as date) as d, cast(o_totalprice as decimal(20,2)) as p from orders)""",
    # spines and generators
    "trading_calendar": f"""select d as trading_day from (select {DAYS.format(a='start_date', b='end_date')} as d from d_bounds) where isodow(d) <= 5""",
    "trading_days_of_month": f"""with b as (select cast(date_trunc('month', max(o_orderdate)) as date) as a,
  cast(date_trunc('month', max(o_orderdate)) + interval 1 month as date) as z from orders)
select d as trading_day from (select {DAYS.format(a='a', b='z')} as d from b) where isodow(d) <= 5""",
    "threshold_bucket": """select o_orderkey, r as draw, case when r < 55 then 'SUBSCRIBE' when r < 95 then 'REDEEM' else 'SWITCH' end as transaction_type,
  case when r < 50 then 'LOW' when r < 85 then 'MEDIUM' else 'HIGH' end as risk_level,
  case when r < 80 then 'RETAIL' when r < 95 then 'PRIORITY' else 'VIP' end as segment
from (select o_orderkey, (o_orderkey * 31 + 17) % 100 as r from orders)""",
    "trade_enrichment": """with l as (select l_orderkey, l_linenumber, l_partkey as p, cast(l_shipdate as date) as d,
  cast(l_quantity as decimal(18,0)) * cast(l_partkey % 90 + 10 as decimal(18,2)) as a, l_linestatus <> 'O' as sold,
  cast(l_extendedprice as decimal(20,2)) as v from lineitem),
m as (select *, case when p % 10 < 8 then 'EQUITY' when p % 10 = 8 then 'DERIVATIVES' else 'OEF' end as k,
  cast(case when p % 10 < 8 then a when p % 10 = 8 then a * 100 else v end as decimal(20,2)) as amount from l)
select k as product_type, l_orderkey, l_linenumber, p as instrument_id, amount,
  cast(round(amount * case k when 'EQUITY' then cast(0.0015 as decimal(9,6)) when 'DERIVATIVES' then cast(0.0002 as decimal(9,6)) else cast(0 as decimal(9,6)) end, 2) as decimal(18,2)) as fee_amount,
  cast(case when k = 'EQUITY' and sold then round(amount * cast(0.001 as decimal(9,6)), 2) when k = 'EQUITY' then 0
    when k = 'DERIVATIVES' then round(amount * cast(0.15 as decimal(9,6)), 2)
    else ((cast(amount * 100 as hugeint) * 200 + (p % 900 + 100)) // (2 * (p % 900 + 100))) * cast(0.0001 as decimal(5,4)) end as decimal(20,4)) as extra,
  d + case when k = 'OEF' then 3 else 2 end as settlement_date
from m""",
    "margin_flags": """select product_type, account_id, loan_date, margin_ratio, cast(0.15 as decimal(9,4)) as maintenance_margin_ratio,
  margin_ratio < 0.15 as call_margin_flag from m_margin""",
    "contract_calendar": """select 'VN30F' || strftime(m, '%y%m') as contract_code, m as contract_month,
  cast(m - interval 3 month as date) as listing_date, last_day(m) as maturity_date
from (select cast(unnest(generate_series(start_date, end_date - 1, interval 1 month)) as date) as m from d_bounds)""",
    "price_bands": "select price_date, security_id, reference_price, ceiling_price, floor_price from d_price",
    # incremental and history
    "incremental_watermark": f"""select source_trade_id, trade_date,
  case when ingested_at > (select max(ingested_at) from s_equity_trade where trade_date < {CUT}) then {FIXED} else amount end as amount
from s_equity_trade""",
    "late_rows": f"""select source_trade_id, trade_date, cast(amount + 1 as decimal(20,2)) as amount from s_equity_trade
where trade_id % 50 = 0 and trade_date < {CUT}""",
    "incremental_per_branch": """select product_type, account_id, balance_date, case
    when product_type = 'EQUITY' and balance_date < date '2024-01-15' then cash_balance
    when product_type = 'DERIVATIVES' and balance_date < date '2024-01-10' then cash_balance
    else cast(cash_balance + 1 as decimal(20,2)) end as cash_balance from m_balance""",
    "upsert_keyed": f"""select source_trade_id, d as trade_date, {FIXED} as amount, cast(date_trunc('month', d) as date) as trade_month
from (select *, case when trade_id % 50 = 0 then trade_date + 40 else trade_date end as d from s_equity_trade)""",
    "schema_append": f"""select source_trade_id, trade_date, amount, case when trade_date >= {CUT} then market end as market from s_equity_trade""",
    "scd2_snapshot": f"""with {STATES}
select customer_code, customer_name, current_broker_code, current_segment, is_active, valid_from, valid_to,
  md5(customer_code || '|' || cast(valid_from as varchar)) as version_id from versions""",
    "dim_customer_history": f"with {STATES}\nselect * exclude (cap), valid_to is null as is_current from versions",
    "profile_as_of": f"""with {STATES}
select customer_code, current_broker_code, current_segment, is_active from versions
where valid_from <= timestamp '2002-01-02 12:00:00' and (valid_to is null or valid_to > timestamp '2002-01-02 12:00:00')""",
    "history_as_of": """select history_id, customer_code, broker_code, valid_from, valid_to, is_current from d_cbh
where valid_from <= date '1998-06-30' and (valid_to is null or valid_to >= date '1998-06-30')""",
    "scd2_apply_changes": f"""with {CHANGES},
firsts as (select customer_code, min(effective_date) as f from judged where ok group by 1)
select h.customer_code, h.broker_code, h.valid_from, case when h.is_current and f is not null then f - 1 else h.valid_to end as valid_to,
  h.is_current and f is null as is_current from d_cbh h left join firsts using (customer_code)
union all
select customer_code, broker_code, effective_date, lead(effective_date) over w - 1, lead(effective_date) over w is null
from judged where ok window w as (partition by customer_code order by effective_date)""",
    "scd2_rejected_changes": f"with {CHANGES}\nselect customer_code, seq, effective_date, broker_code from judged where not ok",
    "scd2_risk_changes": changed("d_risk", "investor_classification, risk_level",
        "'PROFESSIONAL' as investor_classification, 'HIGH' as risk_level", "'NON_PROFESSIONAL', 'MEDIUM'"),
    "scd2_segment_changes": changed("d_segment", "segment", "'PRIORITY' as segment", "'VIP'"),
    "scd2_audit": f"""with h as (select customer_code, valid_from, valid_to, is_current from d_cbh
  union all select {code('KH', 'c_custkey')}, case when c_custkey % 2 = 0 then date '1996-05-01' else date '1990-01-01' end,
    case when c_custkey % 3 = 0 then date '1990-06-30' else date '1996-12-31' end, c_custkey % 7 = 0 from customer),
n as (select *, lead(valid_from) over (partition by customer_code order by valid_from) as nx from h)
select customer_code, count(*) as version_count, count(*) filter (is_current) as current_count,
  count(*) filter (valid_to < valid_from) as inverted_count,
  count(*) filter (nx is not null and (valid_to is null or nx <= valid_to)) as overlap_count,
  count(*) filter (nx > valid_to + 1) as gap_count
from n group by 1""",
    "stream_upsert": """select source_trade_id, trade_date, case when trade_id % 50 = 0 then cast(amount + 1 as decimal(20,2)) else amount end as amount,
  case when trade_id % 50 = 0 then timestamp '2030-01-02 00:00:00' else timestamp '2030-01-01 00:00:00' end as _loaded_at
from s_equity_trade""",
    # quality
    "dq_missing": union([*ALL_MISSING, missing("fact_equity_trade", "customer_code")]),
    "dq_duplicates": union([*ALL_DUPLICATES, duplicates("dim_account", "account_id")]),
    "dq_unique_combo": union([*ALL_COMBOS, duplicates("int_all_trades", "product_type,customer_code")]),
    "dq_accepted_values": union(
        [*ALL_ACCEPTED, accepted("fact_oef_trade", "transaction_type", "'SUBSCRIBE'", "subscribe_only")]
    ),
    "dq_orphans": union([*ALL_ORPHANS, orphaned("int_all_trades", "broker_code", "d_broker", "broker_code")]),
    "dq_row_count": union(ALL_ROWS),
    "dq_non_negative": union(ALL_BOUNDS),
    "dq_freshness": union(ALL_FRESH),
    "dq_source_freshness": union([freshness(f"stg_common__{t}", "2024-02-01 06:00:00", 26, 50) for t in FRESH_SOURCES]),
    "dq_rate_overlap": """select 'prolonged' as source, fee_schedule_id, effective_to + 1 as effective_to, nx as next_from
from (select *, lead(effective_from) over (partition by product_type order by effective_from) as nx from d_fee)
where nx <= effective_to + 1""",
    "dq_rowcount_anomaly": union([f"select * from ({anomalies(t)})" for t in FACTS]),
    "dq_check_constraints": union([constraint(*c) for c in CONSTRAINTS]),
    "dq_unique_where": union(UNIQUE_WHERE),
    "dq_report": union(
        ALL_MISSING + ALL_DUPLICATES + ALL_COMBOS + ALL_ACCEPTED + ALL_ORPHANS + ALL_ROWS + ALL_BOUNDS
        + ALL_FRESH + ALL_ANOMALIES
    ),
    # The first run captures one open version per customer.
    "refresh_job": union(
        ALL_MISSING + ALL_DUPLICATES + ALL_COMBOS + ALL_ACCEPTED + ALL_ORPHANS + ALL_ROWS + ALL_BOUNDS + ALL_ANOMALIES
        + [freshness(t, "2002-01-01 00:00:00") for t in FACTS]
        + [entry("dim_customer_history", "missing", c, "select 0 as o") for c in ("customer_code", "valid_from")]
        + [entry("snap_customer_profile", "missing", c, "select 0 as o") for c in ("version_id", "customer_code")]
        + [
            duplicates("dim_customer_history", "customer_code,valid_from", src="(select customer_code, date '2002-01-01' as valid_from from m_customer)"),
            duplicates("snap_customer_profile", "version_id", src="(select md5(customer_code || '|2002-01-01 00:00:00') as version_id from m_customer)"),
        ]
        + [
            entry(t, "row_count", "", "select count(*) as o from m_customer", "case when o > 0 then 'pass' else 'fail' end")
            for t in ("dim_customer_history", "snap_customer_profile")
        ]
    ),
}
