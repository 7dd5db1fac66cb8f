"""The only place that knows the test tables: maps them to the domain's source tables.

All values are integer arithmetic on keys, so any engine derives the same rows. Whole tables
are mapped: every order is a trade, every line item a position, every event a balance.
"""

from __future__ import annotations

import datetime as dt
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewharf.functions import moment
from tradewharf.registry import Lake
from tradewharf.schemas import LANDED, LANDED_BY_STAGED
from tradewharf.sources.files import land_variant

# Schemas of the test tables, given so that no file is opened to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

LOADED = dt.datetime(2030, 1, 1)
RELOADED = dt.datetime(2030, 1, 2)


def code(prefix: str, key: str, width: int = 10) -> str:
    """Prefix plus zero-padded key; a longer key is kept whole."""
    text = f"cast({key} as string)"
    return f"concat('{prefix}', lpad({text}, greatest({width}, length({text})), '0'))"


def pick(key: str, *values: str) -> str:
    """Value by ``key`` modulo the number of values."""
    cases = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values[:-1]))
    return f"case {key} % {len(values)} {cases} else '{values[-1]}' end"


def steps(draw: str, *bounds: tuple[int, str], last: str) -> str:
    cases = " ".join(f"when {draw} < {b} then '{v}'" for b, v in bounds)
    return f"case {cases} else '{last}' end"


def stamped(system: str) -> list[str]:
    return [
        f"'{system}' as source_system",
        "cast(null as timestamp_ntz) as source_updated_at",
        "timestamp_ntz'2002-01-01 00:00:00' as ingested_at",
    ]


def sourced(system: str, at: str = "timestamp_ntz'2002-01-01 00:00:00'") -> list[str]:
    return [f"'{system}' as source_system", f"{at} as ingested_at"]


BROKER_TYPE = "case when s_suppkey % 10 < 7 then 'BROKER' else 'COLLABORATOR' end"
BROKER_DRAW = "(s_suppkey * 37 + 11) % 100"
BROKER_SUBTYPE = (
    "case when s_suppkey % 10 < 7 then "
    + steps(BROKER_DRAW, (70, "STANDARD"), (90, "SENIOR"), (97, "TEAM_LEAD"), last="RM_VIP")
    + " else "
    + steps(BROKER_DRAW, (60, "REFERRAL_INDIVIDUAL"), (90, "REFERRAL_AFFILIATE"), last="REFERRAL_INSTITUTIONAL")
    + " end"
)
OPENED = "date_add(date'1995-01-01', cast(c_custkey % 700 as int))"
HIRED = "date_add(date'1994-01-01', cast(s_suppkey % 300 as int))"
DAY = "cast(ts as date)"
CENTS = "cast(value as decimal(20,2))"
NAV = "cast(10000 + (fund_id * 977) % 20000 as decimal(18,4))"


@cache
def _variants() -> dict[str, dict]:
    """What differs between the products' trade, position and account mappings."""
    return {
        "EQUITY": {
            "ranks": ("1-URGENT", "2-HIGH", "3-MEDIUM"), "prefix": "EQ-", "system": "CORE_TRADING",
            "account": "0001", "shift": 1, "lag": 2, "has": "{k} % 5 < 4", "class": "l_partkey % 10 < 8",
            "instrument": "security_id", "quantity": "quantity", "cost": "avg_cost_price",
        },
        "DERIVATIVES": {
            "ranks": ("4-NOT SPECIFIED",), "prefix": "DR-", "system": "DERIVATIVES",
            "account": "0002", "shift": 2, "lag": 2, "has": "{k} % 4 = 0", "class": "l_partkey % 10 = 8",
            "instrument": "contract_id", "quantity": "quantity", "cost": "avg_cost_price",
        },
        "OEF": {
            "ranks": ("5-LOW",), "prefix": "OEF-", "system": "OEF",
            "account": "0003", "shift": 3, "lag": 3, "has": "{k} % 5 >= 3", "class": "l_partkey % 10 = 9",
            "instrument": "fund_id", "quantity": "quantity_unit", "cost": "avg_cost_nav",
        },
    }


class DriverTables:
    """Domain source tables derived from one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._read:
            reader = self.spark.read.schema(SCHEMAS[name])
            self._read[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    def pick(self, table: str, *exprs: str, where: str | None = None) -> DataFrame:
        df = self.read(table)
        return (df.where(where) if where else df).selectExpr(*exprs)

    @cached_property
    def brokers_n(self) -> int:
        # Row counts come from file footers.
        return self.read("supplier").count()

    @cached_property
    def parts_n(self) -> int:
        return self.read("part").count()

    @property
    def current_broker(self) -> str:
        return code("MG", f"(c_custkey * 7 + 3) % {self.brokers_n - 5}")

    # -- organisation ---------------------------------------------------------------------

    def branch(self) -> DataFrame:
        return self.pick(
            "region",
            "cast(r_regionkey as bigint) as branch_id",
            f"{code('CN', 'r_regionkey', 2)} as branch_code",
            "r_name as branch_name",
            "concat('1 Main St, ', r_name) as address",
            f"case when r_regionkey < 3 then {code('NV9', 'r_regionkey', 3)} end as director_employee_code",
            "true as is_active",
            *stamped("CRM"),
        )

    def department(self) -> DataFrame:
        return self.pick(
            "nation",
            "cast(n_nationkey as bigint) as department_id",
            f"{code('PB', 'n_nationkey', 3)} as department_code",
            "n_name as department_name",
            "cast(n_regionkey as bigint) as branch_id",
            "'BROKERAGE' as department_type",
            f"case when n_nationkey % 3 = 0 then {code('NV8', 'n_nationkey', 3)} end as head_employee_code",
            "true as is_active",
            *stamped("CRM"),
        )

    def broker(self) -> DataFrame:
        return self.pick(
            "supplier",
            f"{code('MG', 's_suppkey')} as broker_code",
            "s_name as broker_name",
            f"{BROKER_TYPE} as broker_type",
            f"{BROKER_SUBTYPE} as broker_subtype",
            "cast(s_nationkey as bigint) as department_id",
            f"case when s_suppkey % 10 < 7 then {code('NV', 's_suppkey')} end as employee_code",
            f"{code('0900', 's_suppkey')} as id_number",
            f"{code('09', 's_suppkey', 8)} as phone",
            "concat('broker', cast(s_suppkey as string), '@example.com') as email",
            f"{HIRED} as start_date",
            "case when s_suppkey % 17 = 0 then date'2001-12-31' end as end_date",
            "s_suppkey % 17 <> 0 as is_active",
            *stamped("CRM"),
        )

    def employee(self) -> DataFrame:
        """Registry records: three of four brokers, unit heads, directors. Director 2 reports
        to a head of the own branch, which makes a cycle; many manager codes are unknown."""
        nation, region = self.read("nation"), self.read("region")
        unit = nation.join(region, F.expr("n_regionkey = r_regionkey"))
        branch = [f"{code('CN', 'n_regionkey', 2)} as branch_code", "r_name as branch_name"]
        department = [
            f"{code('PB', 'n_nationkey', 3)} as department_code", "n_name as department_name"
        ]
        staff = (
            self.read("supplier").where("s_suppkey % 4 <> 0")
            .join(unit, F.expr("s_nationkey = n_nationkey"))
            .selectExpr(
                f"{code('0900', 's_suppkey')} as id_number",
                f"case when s_suppkey % 10 < 7 then {code('NV', 's_suppkey')} end as employee_code",
                "s_name as full_name",
                "case when s_suppkey % 10 < 7 then 'EMPLOYEE' else 'COLLABORATOR' end as person_type",
                *branch,
                *department,
                "case when s_suppkey % 10 < 7 then 'Broker' else 'Collaborator' end as position",
                f"{BROKER_SUBTYPE} as position_code",
                f"{BROKER_TYPE} as position_level",
                f"case when s_suppkey % 10 < 7 then {code('NV8', 'n_nationkey', 3)} end as manager_employee_code",
                f"cast({HIRED} as string) as start_date",
                "case when s_suppkey % 17 = 0 then '2001-12-31' end as end_date",
                "case when s_suppkey % 17 = 0 then 'INACTIVE' else 'ACTIVE' end as status",
            )
        )
        heads = unit.where("n_nationkey % 3 = 0").selectExpr(
            f"{code('0800', 'n_nationkey')} as id_number",
            f"{code('NV8', 'n_nationkey', 3)} as employee_code",
            "concat('Head of ', n_name) as full_name",
            "'EMPLOYEE' as person_type",
            *branch,
            *department,
            "'Head of department' as position",
            "'HEAD_OF_DEPARTMENT' as position_code",
            "'HEAD_OF_DEPARTMENT' as position_level",
            f"{code('NV9', 'n_regionkey', 3)} as manager_employee_code",
            "'1993-01-01' as start_date",
            "cast(null as string) as end_date",
            "'ACTIVE' as status",
        )
        directors = region.where("r_regionkey < 3").selectExpr(
            f"{code('0700', 'r_regionkey')} as id_number",
            f"{code('NV9', 'r_regionkey', 3)} as employee_code",
            "concat('Director of ', r_name) as full_name",
            "'EMPLOYEE' as person_type",
            f"{code('CN', 'r_regionkey', 2)} as branch_code",
            "r_name as branch_name",
            "cast(null as string) as department_code",
            "cast(null as string) as department_name",
            "'Branch director' as position",
            "'BRANCH_DIRECTOR' as position_code",
            "'BRANCH_DIRECTOR' as position_level",
            "case when r_regionkey = 2 then 'NV8012' end as manager_employee_code",
            "'1992-01-01' as start_date",
            "cast(null as string) as end_date",
            "'ACTIVE' as status",
        )
        return staff.unionByName(heads).unionByName(directors)

    # -- customers ------------------------------------------------------------------------

    def customer(self) -> DataFrame:
        return self.pick(
            "customer",
            f"{code('KH', 'c_custkey')} as customer_code",
            "c_name as customer_name",
            "case when c_custkey < 2 then 'PROPRIETARY' when c_custkey % 10 = 0 then 'ORGANIZATION' "
            "else 'INDIVIDUAL' end as customer_type",
            "case when c_custkey >= 2 and (c_custkey * 7919 + 13) % 100 < 8 then 'FOREIGN' "
            "else 'DOMESTIC' end as residency",
            f"{code('0600', 'c_custkey')} as id_number",
            f"{code('08', 'c_custkey', 8)} as phone",
            "concat('customer', cast(c_custkey as string), '@example.com') as email",
            f"{OPENED} as open_date",
            "c_custkey % 20 <> 7 as is_active",
            *stamped("CRM"),
        )

    def _history(self, where: str, columns: str, early: list[str], split: str, late: list[str]) -> DataFrame:
        """Open version of every customer, and before it a closed one where ``split`` holds."""
        names = columns.split()
        old = ", ".join(f"'{n}', {e}" for n, e in zip(names, early))
        new = ", ".join(f"'{n}', {e}" for n, e in zip(names, late))
        versions = (
            f"filter(array(case when {split} then named_struct({old}) end, named_struct({new})), "
            "v -> v is not null)"
        )
        return (
            self.pick("customer", f"{code('KH', 'c_custkey')} as customer_code", f"inline({versions})", where=where)
            .selectExpr(
                "history_id", "customer_code", *names[1:], *sourced("CRM")
            )
        )

    def customer_broker_history(self) -> DataFrame:
        """One in fifty customers has no broker; five brokers manage nobody."""
        change = "case when c_custkey % 7 = 1 then date'2024-01-15' else date'1998-07-01' end"
        return self._history(
            "c_custkey % 50 <> 9",
            "history_id broker_code valid_from valid_to is_current",
            [
                "c_custkey * 2", code("MG", f"c_custkey % {self.brokers_n - 5}"), "date'1995-01-01'",
                f"date_add({change}, -1)", "false",
            ],
            "c_custkey % 3 <> 0",
            [
                "c_custkey * 2 + 1", self.current_broker,
                f"case when c_custkey % 3 = 0 then date'1995-01-01' else {change} end",
                "cast(null as date)", "true",
            ],
        )

    def _profile(self, columns: str, early: list[str], late: list[str]) -> DataFrame:
        return self._history(
            "true",
            f"history_id {columns} valid_from valid_to is_current",
            ["c_custkey * 2", *early, OPENED, f"date_add({OPENED}, 99)", "false"],
            "c_custkey % 4 = 0",
            [
                "c_custkey * 2 + 1", *late,
                f"case when c_custkey % 4 = 0 then date_add({OPENED}, 100) else {OPENED} end",
                "cast(null as date)", "true",
            ],
        )

    def customer_risk_profile(self) -> DataFrame:
        draw = "(c_custkey * 13 + 5) % 100"
        return self._profile(
            "investor_classification risk_level",
            ["'NON_PROFESSIONAL'", "'LOW'"],
            [
                steps(draw, (5, "PROFESSIONAL"), last="NON_PROFESSIONAL"),
                steps(draw, (50, "LOW"), (85, "MEDIUM"), last="HIGH"),
            ],
        )

    def customer_segment_history(self) -> DataFrame:
        draw = steps("(c_custkey * 29 + 7) % 100", (80, "RETAIL"), (95, "PRIORITY"), last="VIP")
        return self._profile(
            "segment", ["'RETAIL'"], [f"case when c_custkey < 2 then 'VIP' else {draw} end"]
        )

    def customer_acquisition(self) -> DataFrame:
        channel = steps(
            "(c_custkey * 53 + 1) % 100", (40, "BRANCH"), (75, "ONLINE"), (95, "REFERRAL"), last="EVENT"
        )
        return self.pick(
            "customer",
            f"{code('KH', 'c_custkey')} as customer_code",
            f"{channel} as acquisition_channel",
            f"case when {channel} = 'REFERRAL' and c_custkey % 50 <> 9 then {self.current_broker} end "
            "as referral_broker_code",
            f"{OPENED} as acquisition_date",
            f"case when {channel} = 'ONLINE' and c_custkey % 2 = 0 "
            f"then concat('CMP', cast(year({OPENED}) as string)) end as campaign_code",
            *sourced("CRM"),
            where="c_custkey % 60 <> 11",
        )

    # -- schedules, market ------------------------------------------------------------------

    def fee_schedule(self) -> DataFrame:
        """One rate per product and year, found in the part keys; funds have none in 1995."""
        rates = self.pick(
            "part",
            "case when p_partkey % 10 < 8 then 0 when p_partkey % 10 = 8 then 1 else 2 end as p",
            "cast(p_partkey % 7 as int) as y",
        ).distinct().where("not (p = 2 and y = 0)")
        return rates.selectExpr(
            "cast(p * 100 + y as bigint) as fee_schedule_id",
            "case p when 0 then 'EQUITY' when 1 then 'DERIVATIVES' else 'OEF' end as product_type",
            "cast(null as string) as broker_tier",
            "cast(case p when 0 then 0.0015 when 1 then 0.0002 else 0 end as decimal(9,6)) as fee_rate",
            "cast(case p when 0 then (30 - y) / 100.0 when 1 then 0.25 else 0.5 end as decimal(9,6)) "
            "as commission_rate",
            "make_date(1995 + y, 1, 1) as effective_from",
            "case when y < 6 then make_date(1995 + y, 12, 31) end as effective_to",
            "y = 6 as is_current",
            *sourced("FINANCE"),
        )

    def management_commission_schedule(self) -> DataFrame:
        """A superseded and a current rate per level, found in the supplier keys."""
        rates = self.pick(
            "supplier", "cast(s_suppkey % 2 as int) as l", "cast((s_suppkey div 2) % 2 as int) as c"
        ).distinct()
        return rates.selectExpr(
            "cast(l * 10 + c as bigint) as schedule_id",
            "case l when 0 then 'HEAD_OF_DEPARTMENT' else 'BRANCH_DIRECTOR' end as management_level",
            "cast(case when l = 0 and c = 1 then 0.05 when l = 0 then 0.04 when c = 1 then 0.03 "
            "else 0.02 end as decimal(9,6)) as commission_rate",
            "case c when 1 then date'1998-01-01' else date'1995-01-01' end as effective_from",
            "case c when 0 then date'1997-12-31' end as effective_to",
            "c = 1 as is_current",
            *sourced("FINANCE"),
        )

    def market_index_price(self) -> DataFrame:
        daily = self.read("events").groupBy(F.expr(f"{DAY} as price_date")).agg(
            F.expr(f"sum({CENTS}) as v"), F.expr("count(1) as n")
        )
        return daily.selectExpr(
            "price_date", "v", "n",
            "inline(array(named_struct('index_code', 'VNINDEX', 'base', 1200), "
            "named_struct('index_code', 'VN30', 'base', 1300)))",
        ).selectExpr(
            "price_date",
            "index_code",
            "cast(base + v % 100 as decimal(18,2)) as close_value",
            "cast(null as decimal(9,4)) as change_percent",
            "cast(n as decimal(20,0)) as volume",
            *sourced("MARKET"),
        )

    # -- compliance -------------------------------------------------------------------------

    def trading_alert(self) -> DataFrame:
        return self.pick(
            "events",
            "event_id as alert_id",
            f"{DAY} as alert_date",
            f"{code('KH', 'user_id')} as customer_code",
            f"{code('MG', f'event_id % {self.brokers_n}')} as broker_code",
            f"{pick('event_id', 'EQUITY', 'DERIVATIVES', 'OEF')} as related_product_type",
            f"{pick('event_id', 'CORE_TRADING', 'DERIVATIVES', 'OEF')} as related_source_system",
            f"concat({pick('event_id', 'EQ', 'DR', 'OEF')}, {code('-', 'event_id')}) as related_trade_id",
            f"{pick('event_id', 'UNUSUAL_VOLUME', 'WASH_TRADE')} as alert_type",
            f"{pick('event_id', 'LOW', 'MEDIUM', 'HIGH')} as severity",
            f"{pick('event_id', 'OPEN', 'REVIEWING', 'CLOSED', 'ESCALATED')} as status",
            "cast(null as string) as description",
            *sourced("COMPLIANCE", "ts"),
            where="event_type = 'error'",
        )

    def customer_complaint(self) -> DataFrame:
        return self.pick(
            "events",
            "event_id as complaint_id",
            f"{code('KH', 'user_id')} as customer_code",
            f"case when event_id % 5 <> 0 then {code('MG', f'event_id % {self.brokers_n}')} end as broker_code",
            f"{DAY} as complaint_date",
            f"{pick('event_id', 'HOTLINE', 'APP')} as channel",
            f"{pick('event_id', 'FEE', 'EXECUTION', 'SERVICE')} as category",
            f"{pick('event_id', 'OPEN', 'IN_PROGRESS', 'RESOLVED', 'CLOSED')} as status",
            f"case when event_id % 4 >= 2 then date_add({DAY}, cast(event_id % 10 as int)) end as resolution_date",
            "cast(null as string) as description",
            *sourced("CRM", "ts"),
            where="event_type = 'click'",
        )

    # -- instruments, accounts ----------------------------------------------------------------

    def security(self) -> DataFrame:
        return self.pick(
            "part",
            "p_partkey as security_id",
            f"{code('S', 'p_partkey')} as symbol",
            "p_name as security_name",
            f"{pick('p_partkey', 'HOSE', 'HNX', 'UPCOM')} as exchange",
            "p_type as sector",
            "'STOCK' as security_type",
            "date_add(date'1990-01-01', cast(p_partkey % 1000 as int)) as listing_date",
            "p_size > 2 as is_active",
            *stamped("CORE_TRADING"),
            where="p_partkey % 10 < 8",
        )

    def derivative_contract(self) -> DataFrame:
        listed = "date_add(date'1995-01-01', cast((p_partkey * 7) % 2000 as int))"
        return self.pick(
            "part",
            "p_partkey as contract_id",
            f"{code('F', 'p_partkey')} as contract_code",
            "'VN30' as underlying_symbol",
            "'INDEX_FUTURES' as contract_type",
            "cast(100000 as decimal(18,2)) as multiplier",
            f"{listed} as listing_date",
            f"last_day(add_months({listed}, 3)) as maturity_date",
            "p_size > 2 as is_active",
            *stamped("DERIVATIVES"),
            where="p_partkey % 10 = 8",
        )

    def fund(self) -> DataFrame:
        return self.pick(
            "part",
            "p_partkey as fund_id",
            f"{code('Q', 'p_partkey')} as fund_code",
            "p_name as fund_name",
            f"{pick('p_partkey', 'BOND_FUND', 'EQUITY_FUND', 'BALANCED_FUND')} as fund_type",
            "p_brand as fund_manager",
            "date_add(date'1990-01-01', cast(p_partkey % 1000 as int)) as inception_date",
            "p_size > 2 as is_active",
            *stamped("OEF"),
            where="p_partkey % 10 = 9",
        )

    def account(self, product: str) -> DataFrame:
        """Account ids repeat across products on purpose."""
        v = _variants()[product]
        return self.pick(
            "customer",
            "c_custkey + 1 as account_id",
            f"{code(v['account'], 'c_custkey')} as account_no",
            f"{code('KH', 'c_custkey')} as customer_code",
            f"case when c_custkey % 50 <> 9 then {self.current_broker} end as broker_code",
            f"{OPENED} as open_date",
            "c_custkey % 20 <> 7 as is_active",
            *stamped("CORE_TRADING"),
            where=v["has"].format(k="c_custkey"),
        )

    # -- daily snapshots ------------------------------------------------------------------------

    def _user_days(self, product: str, day: str, *aggs: str) -> DataFrame:
        return (
            self.read("events").where(_variants()[product]["has"].format(k="user_id"))
            .groupBy(F.expr(f"{DAY} as {day}"), F.expr("user_id + 1 as account_id"))
            .agg(*[F.expr(a) for a in aggs])
        )

    def account_balance_daily(self, product: str) -> DataFrame:
        daily = self._user_days(product, "balance_date", f"sum({CENTS}) as s", f"max({CENTS}) as m")
        return daily.selectExpr(
            "balance_date", "account_id",
            "cast(s * 1000 as decimal(20,2)) as cash_balance",
            "cast(m * 5000 as decimal(20,2)) as portfolio_value",
            "cast(s * 1000 + m * 5000 as decimal(20,2)) as total_asset_value",
        )

    def margin_loan_daily(self, product: str) -> DataFrame:
        daily = self._user_days(product, "loan_date", f"sum({CENTS}) as s", "max(event_id) as e")
        return daily.selectExpr(
            "loan_date", "account_id",
            "cast(s * 300 as decimal(20,2)) as margin_loan_balance",
            "cast(cast(e % 40 + 10 as decimal(9,4)) / 100 as decimal(9,4)) as margin_ratio",
            "cast(0.15 as decimal(9,4)) as maintenance_margin_ratio",
            "e % 7 = 0 as call_margin_flag",
        )

    def position_daily(self, product: str) -> DataFrame:
        """Positions per supplier-keyed account, part and ship date."""
        v = _variants()[product]
        name = v["instrument"]
        daily = (
            self.read("lineitem").where(v["class"])
            .groupBy(
                F.expr("cast(l_shipdate as date) as position_date"),
                F.expr("l_suppkey + 1 as account_id"),
                F.expr(f"l_partkey as {name}"),
            )
            .agg(
                F.expr("sum(cast(l_quantity as decimal(20,2))) as q"),
                F.expr("sum(cast(l_extendedprice as decimal(20,2))) as v"),
            )
        )
        side = [f"case when {name} % 20 < 10 then 'LONG' else 'SHORT' end as position_side"]
        return daily.selectExpr(
            "position_date", "account_id", name,
            *(side if product == "DERIVATIVES" else []),
            f"cast(q as decimal(20,4)) as {v['quantity']}",
            f"cast(1000 + {name} % 1000 as decimal(18,4)) as {v['cost']}",
            "cast(v as decimal(20,2)) as market_value",
        )

    # -- trades and prices ------------------------------------------------------------------------

    def _orders(self, product: str) -> DataFrame:
        """Orders of one product with the columns all trade tables share. One order in 97 has
        no broker, one in 89 an unknown one; one customer in 25 never trades (its orders
        carry no customer)."""
        v = _variants()[product]
        ranks = ", ".join(f"'{r}'" for r in v["ranks"])
        broker = code("MG", f"(o_orderkey * 31 + 7) % {self.brokers_n}")
        return self.pick(
            "orders",
            "o_orderkey as k",
            f"o_orderkey + {v['shift']} as trade_id",
            "cast(o_orderdate as date) as trade_date",
            "o_orderdate + make_dt_interval(0, 9, 0, cast(o_orderkey % 21600 as int)) as trade_datetime",
            f"{code(v['prefix'], 'o_orderkey')} as source_trade_id",
            f"{code(v['account'], 'o_custkey')} as account_no",
            f"case when o_custkey % 25 <> 3 then {code('KH', 'o_custkey')} end as customer_code",
            "case when o_orderkey % 97 = 0 then null when o_orderkey % 89 = 0 then 'MGX' "
            f"else {broker} end as broker_code",
            f"((o_orderkey * 13 + 5) % {self.parts_n // 10}) * 10 as base10",
            "cast(o_totalprice as decimal(20,2)) as amount",
            f"date_add(cast(o_orderdate as date), {v['lag']}) as settlement_date",
            "concat('ORD-', cast(o_orderkey as string)) as order_id",
            f"'{v['system']}' as source_system",
            "o_orderdate + interval 1 day 2 hours as ingested_at",
            where=f"o_orderpriority in ({ranks})",
        )

    def trades(self, product: str) -> DataFrame:
        def share(rate: str, kind: str = "decimal(18,2)") -> str:
            return f"cast(round(amount * cast({rate} as decimal(9,6)), 2) as {kind})"

        own = {
            "EQUITY": {
                "security_id": "base10 + k % 8",
                "market": pick("k", "HOSE", "HNX", "UPCOM"),
                "side": pick("k", "BUY", "SELL"),
                "order_type": "'LO'",
                "quantity": "cast((k % 50 + 1) * 100 as decimal(18,0))",
                "price": "cast(k % 90 + 10 as decimal(18,2))",
                "fee_amount": share("0.0015"),
                "tax_amount": f"case when k % 2 = 0 then cast(0 as decimal(18,2)) else {share('0.001')} end",
            },
            "DERIVATIVES": {
                "contract_id": "base10 + 8",
                "position_side": pick("k", "LONG", "SHORT"),
                "order_action": "case when k % 10 < 6 then 'OPEN' else 'CLOSE' end",
                "quantity": "cast(k % 20 + 1 as decimal(18,0))",
                "price": "cast(k % 200 + 1200 as decimal(18,2))",
                "margin_amount": share("0.15", "decimal(20,2)"),
                "fee_amount": share("0.0002"),
            },
            "OEF": {
                "fund_id": "base10 + 9",
                "transaction_type": "case when k % 20 = 0 then 'SWITCH' when k % 20 < 12 then 'SUBSCRIBE' "
                "else 'REDEEM' end",
                "quantity_unit": f"cast(round(amount / {NAV.replace('fund_id', '(base10 + 9)')}, 4) as decimal(20,4))",
                "nav_price": NAV.replace("fund_id", "(base10 + 9)"),
                "fee_amount": "cast(0 as decimal(18,2))",
            },
        }[product]
        spec = LANDED_BY_STAGED[TRADE_TABLES[product]]
        exprs = [f"{own[c]} as {c}" if c in own else c for c in spec.payload]
        return self._orders(product).selectExpr(*exprs)

    def daily_price(self) -> DataFrame:
        """Price of each security on the days it traded, with its price band."""
        traded = self.trades("EQUITY").groupBy("trade_date", "security_id").agg(
            F.expr("sum(quantity) as volume")
        )
        ref = "cast(security_id % 90 + 10 as decimal(18,2))"
        return traded.selectExpr(
            "trade_date as price_date",
            "security_id",
            f"cast({ref} + dayofmonth(trade_date) / 100.0 as decimal(18,2)) as close_price",
            f"{ref} as reference_price",
            f"cast(round({ref} * 1.07, 2) as decimal(18,2)) as ceiling_price",
            f"cast(round({ref} * 0.93, 2) as decimal(18,2)) as floor_price",
            "cast(volume as decimal(20,0)) as volume",
            *sourced("MARKET"),
        )

    def daily_settlement_price(self) -> DataFrame:
        traded = self.trades("DERIVATIVES").groupBy("trade_date", "contract_id").agg(
            F.expr("sum(quantity) as volume"), F.expr("count(1) as n")
        )
        return traded.selectExpr(
            "trade_date as price_date",
            "contract_id",
            "cast(1300 + contract_id % 100 + dayofmonth(trade_date) as decimal(18,2)) as settlement_price",
            "cast(n as decimal(20,0)) as open_interest",
            "cast(volume as decimal(20,0)) as volume",
            *sourced("MARKET"),
        )

    def fund_nav_history(self) -> DataFrame:
        """NAV of each traded fund, published on even days of the month only."""
        traded = (
            self.trades("OEF").where("dayofmonth(trade_date) % 2 = 0")
            .groupBy("trade_date", "fund_id").agg(F.expr("sum(quantity_unit) as u"))
        )
        return traded.selectExpr(
            "trade_date as nav_date",
            "fund_id",
            f"cast({NAV} + dayofmonth(trade_date) as decimal(18,4)) as nav_price",
            "cast(null as decimal(24,2)) as total_net_asset",
            "cast(u as decimal(24,4)) as outstanding_units",
            *sourced("MARKET"),
        )

    def calendar_bounds(self) -> DataFrame:
        """Whole years covered by the trades: [first January, January after the last)."""
        return self.read("orders").agg(
            F.expr("trunc(cast(min(o_orderdate) as date), 'YEAR') as start_date"),
            F.expr("add_months(trunc(cast(max(o_orderdate) as date), 'YEAR'), 12) as end_date"),
        )

    # -- lakes ------------------------------------------------------------------------------------

    def staged(self, name: str) -> DataFrame:
        """A heavy table as it looks after staging."""
        product = PRODUCT_OF[name.split("__")[0]]
        table = name.split("__")[1]
        if table.endswith("_trade"):
            return self.trades(product)
        return getattr(self, table)(product)

    def corrected(self, name: str) -> DataFrame:
        """Corrected copies (value + 1) of one row in fifty of a heavy table."""
        spec = LANDED_BY_STAGED[name]
        table = name.split("__")[1]
        column, key = CORRECTED["trade" if table.endswith("_trade") else table]
        return self.staged(name).where(f"{key} % 50 = 0").withColumn(
            column, F.expr(f"cast({column} + 1 as {spec.payload[column]})")
        )

    def landed(self, name: str) -> DataFrame:
        """VARIANT landing of a heavy table: every row, and the corrections in a later file."""
        spec = LANDED_BY_STAGED[name]
        return land_variant(
            self.staged(name), moment(LOADED), F.lit(f"{spec.table}/part-0000.parquet")
        ).unionByName(
            land_variant(self.corrected(name), moment(RELOADED), F.lit(f"{spec.table}/part-0001.parquet"))
        )

    def sources(self) -> dict:
        """Source tables of the lakehouse, and the landed tables as VARIANT rows."""
        out = {
            "common.branch": self.branch,
            "common.department": self.department,
            "common.broker": self.broker,
            "common.customer": self.customer,
            "common.customer_broker_history": self.customer_broker_history,
            "common.customer_acquisition": self.customer_acquisition,
            "common.customer_risk_profile": self.customer_risk_profile,
            "common.customer_segment_history": self.customer_segment_history,
            "common.fee_schedule": self.fee_schedule,
            "common.management_commission_schedule": self.management_commission_schedule,
            "common.market_index_price": self.market_index_price,
            "common.trading_alert": self.trading_alert,
            "common.customer_complaint": self.customer_complaint,
            "equity.security": self.security,
            "equity.daily_price": self.daily_price,
            "equity.account": lambda: self.account("EQUITY"),
            "derivatives.derivative_contract": self.derivative_contract,
            "derivatives.daily_settlement_price": self.daily_settlement_price,
            "derivatives.account": lambda: self.account("DERIVATIVES"),
            "oef.fund": self.fund,
            "oef.fund_nav_history": self.fund_nav_history,
            "oef.account": lambda: self.account("OEF"),
            "hr.employee": self.employee,
            "calendar_bounds": self.calendar_bounds,
        }
        for spec in LANDED:
            out[spec.raw] = lambda s=spec.staged: self.landed(s)
        return out

    def landed_lake(self, as_of: dt.date | None = None) -> Lake:
        """Lake that starts from the VARIANT landing."""
        return Lake(self.spark, self.sources(), as_of)

    def lake(self, as_of: dt.date | None = None) -> Lake:
        """Lake whose heavy staging tables are already typed, as after a refresh."""
        typed = {s.staged: (lambda n=s.staged: self.staged(n)) for s in LANDED}
        return Lake(self.spark, {**self.sources(), **typed}, as_of)


TRADE_TABLES = {
    "EQUITY": "stg_equity__equity_trade",
    "DERIVATIVES": "stg_derivatives__derivative_trade",
    "OEF": "stg_oef__oef_trade",
}
PRODUCT_OF = {"stg_equity": "EQUITY", "stg_derivatives": "DERIVATIVES", "stg_oef": "OEF"}
# Column a correction changes, and the key that selects the corrected rows.
CORRECTED = {
    "trade": ("amount", "trade_id"),
    "account_balance_daily": ("cash_balance", "account_id"),
    "margin_loan_daily": ("margin_loan_balance", "account_id"),
    "position_daily": ("market_value", "account_id"),
}
