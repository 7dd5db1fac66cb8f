"""Dimensions of the gold layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewharf.operators.calendars import date_parts, date_spine, fixed_bounds
from tradewharf.operators.relational import union_tagged
from tradewharf.registry import model
from tradewharf.schemas import PASSTHROUGH

LAYER = "MARTS"

PROFILE_COLUMNS = (
    "customer_code",
    "customer_name",
    "customer_type",
    "residency",
    "open_date",
    "is_active",
    "current_broker_code",
    "current_segment",
    "investor_classification",
    "current_risk_level",
    "acquisition_channel",
    "acquisition_date",
    "referral_broker_code",
    "campaign_code",
)
#: Columns whose change opens a new version of the customer profile.
PROFILE_CHECKS = (
    "current_broker_code",
    "current_segment",
    "current_risk_level",
    "investor_classification",
    "is_active",
)


def _projection(name: str, source: str, columns: str) -> None:
    model(name, LAYER, [source])(lambda df, cols=tuple(columns.split()): df.select(*cols))


_projection(
    "dim_customer_broker_history",
    "stg_common__customer_broker_history",
    "history_id customer_code broker_code valid_from valid_to is_current",
)
_projection(
    "dim_derivative_contract",
    "stg_derivatives__derivative_contract",
    PASSTHROUGH["derivatives.derivative_contract"],
)
_projection("dim_employee", "stg_hr__employee", PASSTHROUGH["hr.employee"])
_projection("dim_fee_schedule", "stg_common__fee_schedule", PASSTHROUGH["common.fee_schedule"])
_projection("dim_fund", "stg_oef__fund", PASSTHROUGH["oef.fund"])
_projection(
    "dim_management_commission_schedule",
    "stg_common__management_commission_schedule",
    PASSTHROUGH["common.management_commission_schedule"],
)
_projection("dim_security", "stg_equity__security", PASSTHROUGH["equity.security"])


@model("dim_account", LAYER, ["stg_equity__account", "stg_derivatives__account", "stg_oef__account"])
def dim_account(equity: DataFrame, derivatives: DataFrame, oef: DataFrame) -> DataFrame:
    """Accounts of all products. ``account_id`` repeats across products: always join on
    (product_type, account_id)."""
    return union_tagged(
        {"EQUITY": equity, "DERIVATIVES": derivatives, "OEF": oef},
        "product_type",
        PASSTHROUGH["equity.account"].split(),
    )


def _with_person(df: DataFrame, people: DataFrame, code: str, out: str) -> DataFrame:
    names = people.where(F.col("employee_code").isNotNull()).select(
        F.col("employee_code").alias("_code"), F.col("full_name").alias(out)
    )
    return df.join(names, F.col(code) == F.col("_code"), "left").drop("_code")


@model("dim_branch", LAYER, ["stg_common__branch", "stg_hr__employee"])
def dim_branch(branch: DataFrame, people: DataFrame) -> DataFrame:
    out = _with_person(branch, people, "director_employee_code", "director_name")
    return out.select(
        "branch_id", "branch_code", "branch_name", "address", "director_employee_code",
        "director_name", "is_active",
    )


@model("dim_department", LAYER, ["stg_common__department", "stg_hr__employee"])
def dim_department(department: DataFrame, people: DataFrame) -> DataFrame:
    out = _with_person(department, people, "head_employee_code", "head_name")
    return out.select(
        "department_id", "department_code", "department_name", "branch_id", "department_type",
        "head_employee_code", "head_name", "is_active",
    )


@model("dim_broker", LAYER, ["stg_common__broker", "stg_common__department", "stg_common__branch", "stg_hr__employee"])
def dim_broker(
    broker: DataFrame, department: DataFrame, branch: DataFrame, people: DataFrame
) -> DataFrame:
    """Brokers and collaborators with their unit and registry record.

    The registry is matched on the identity number: collaborators have no employee code.
    Only attributes of the unit tables are read, so the manager-name joins of their own
    dimensions are not repeated here.
    """
    dep = department.select(
        F.col("department_id").alias("_dep"), "department_name", F.col("branch_id").alias("branch_id")
    )
    bra = branch.select(F.col("branch_id").alias("_bra"), "branch_name")
    hr = people.select(
        F.col("id_number").alias("_id"), "position_level", "manager_employee_code"
    )
    return (
        broker.join(dep, F.col("department_id") == F.col("_dep"), "left")
        .join(bra, F.col("branch_id") == F.col("_bra"), "left")
        .join(hr, F.col("id_number") == F.col("_id"), "left")
        .select(
            "broker_code", "broker_name", "broker_type", "broker_subtype", "department_id",
            "department_name", "branch_id", "branch_name", "employee_code", "id_number",
            "position_level", "manager_employee_code", "phone", "email", "start_date", "end_date",
            broker["is_active"],
        )
    )


@model("dim_broker_public", LAYER, ["dim_broker"])
def dim_broker_public(brokers: DataFrame) -> DataFrame:
    """``dim_broker`` without the identity number, for publishing."""
    return brokers.drop("id_number")


@model(
    "dim_customer",
    LAYER,
    [
        "stg_common__customer",
        "dim_customer_broker_history",
        "stg_common__customer_segment_history",
        "stg_common__customer_risk_profile",
        "stg_common__customer_acquisition",
    ],
)
def dim_customer(
    customer: DataFrame,
    broker_history: DataFrame,
    segment_history: DataFrame,
    risk_history: DataFrame,
    acquisition: DataFrame,
) -> DataFrame:
    """Customer as of now: base attributes and the current broker, segment and risk.

    All joins use the customer code, so one partitioning of each input serves the chain.
    """
    broker = broker_history.where("is_current").select(
        "customer_code", F.col("broker_code").alias("current_broker_code")
    )
    segment = segment_history.where("is_current").select(
        "customer_code", F.col("segment").alias("current_segment")
    )
    risk = risk_history.where("is_current").select(
        "customer_code", "investor_classification", F.col("risk_level").alias("current_risk_level")
    )
    origin = acquisition.select(
        "customer_code", "acquisition_channel", "acquisition_date", "referral_broker_code",
        "campaign_code",
    )
    out = customer
    for part in (broker, segment, risk, origin):
        out = out.join(part, "customer_code", "left")
    return out.select(*PROFILE_COLUMNS)


@model("dim_customer_history", LAYER, ["snap_customer_profile"])
def dim_customer_history(snapshot: DataFrame) -> DataFrame:
    """Every captured version of the customer profile."""
    return snapshot.select(
        *PROFILE_COLUMNS, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current")
    )


def calendar_dim(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Calendar attributes for every day in [start, end)."""
    return date_parts(date_spine(bounds, start, end))


@model("dim_date", LAYER, ["calendar_bounds"])
def dim_date(bounds: DataFrame) -> DataFrame:
    return calendar_dim(bounds)


def default_calendar_bounds(spark) -> DataFrame:
    """2020-01-01 up to, not including, 2031-01-01."""
    return fixed_bounds(spark, dt.date(2020, 1, 1), dt.date(2031, 1, 1))
