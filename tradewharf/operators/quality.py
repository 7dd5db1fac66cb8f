"""Declarative quality checks.

All scalar checks of one table compile to a single aggregate over it; key checks
(duplicates, orphans) add one aggregate or anti join each. The report is an ordinary
DataFrame ``(table_name, check_name, column_name, observed, status)``. ``run_checks`` is one
lazy plan, for a few tables; ``write_checks`` runs table by table, for a whole lake.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewharf.operators.relational import orphan_keys, union_frames
from tradewharf.session import measured_broadcasts, work_path

REPORT = "table_name string, check_name string, column_name string, observed bigint, status string"
#: Tables checked side by side: the driver holds the plans of so many, however many there are.
AT_ONCE = 2
SCALAR = {"row_count", "missing", "accepted_values", "non_negative", "constraint", "freshness"}


@dataclass(frozen=True)
class Check:
    """One check. ``kind`` is one of the scalar kinds, ``duplicates``, ``orphans`` or
    ``anomaly``; ``where`` restricts the rows looked at (conditional uniqueness)."""

    table: str
    kind: str
    columns: tuple[str, ...] = ()
    values: tuple = ()
    parent: str | None = None
    parent_key: str | None = None
    where: str | None = None
    expr: str | None = None
    name: str | None = None
    warn_hours: float | None = None
    fail_hours: float | None = None
    options: Mapping = field(default_factory=dict)

    @property
    def label(self) -> str:
        return self.name or self.kind


class QualityError(RuntimeError):
    """Raised by ``gate`` when a check failed."""


def _validate(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> None:
    for c in checks:
        if c.table not in tables:
            raise ValueError(f"check on unknown table {c.table}")
        missing = [x for x in c.columns if x not in tables[c.table].columns]
        if missing:
            raise ValueError(f"check {c.label} on {c.table}: unknown column {', '.join(missing)}")


def _text(value) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def _scalar(c: Check, as_of: dt.datetime) -> str:
    """Aggregate expression of a scalar check."""
    col = f"`{c.columns[0]}`" if c.columns else ""
    if c.kind == "row_count":
        return "count(1)"
    if c.kind == "missing":
        return f"count_if({col} is null)"
    if c.kind == "accepted_values":
        return f"count_if({col} not in ({', '.join(map(_text, c.values))}))"
    if c.kind == "non_negative":
        return f"count_if({col} < 0)"
    if c.kind == "constraint":
        return f"count_if(not ({c.expr}))"
    # Whole hours since the newest row, NULL when there is none.
    now = f"timestamp_ntz'{as_of.isoformat(sep=' ')}'"
    return f"timestampdiff(HOUR, cast(max({col}) as timestamp_ntz), {now})"


def _status(c: Check, observed: str) -> str:
    if c.kind == "row_count":
        return f"case when {observed} > 0 then 'pass' else 'fail' end"
    if c.kind == "freshness":
        steps = f"when {observed} is null then 'fail'"
        if c.fail_hours is not None:
            steps += f" when {observed} >= {c.fail_hours} then 'fail'"
        if c.warn_hours is not None:
            steps += f" when {observed} >= {c.warn_hours} then 'warn'"
        return f"case {steps} else 'pass' end"
    return f"case when {observed} = 0 then 'pass' else 'fail' end"


def _entries(found: Sequence[tuple[Check, str]]) -> str:
    """Report rows of several checks, each with the column that holds its count."""
    rows = [
        f"named_struct('table_name', {_text(c.table)}, 'check_name', {_text(c.label)}, "
        f"'column_name', {_text(','.join(c.columns))}, 'observed', cast({o} as bigint), "
        f"'status', {_status(c, o)})"
        for c, o in found
    ]
    return f"inline(array({', '.join(rows)}))"


def duplicate_keys(df: DataFrame, keys: Sequence[str], where: str | None = None) -> DataFrame:
    """Key values that occur more than once. NULL keys count as equal to each other only
    when a ``where`` clause asks for conditional uniqueness; otherwise they are skipped."""
    rows = df.where(where) if where else df.dropna(subset=list(keys))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def rowcount_anomalies(
    df: DataFrame, day_col: str, look_back: int = 7, sensitivity: float = 0.7
) -> DataFrame:
    """Daily row counts against the mean and deviation of the ``look_back`` days before.

    Definition: a day is an anomaly when ``|count - mean| > 2 * stddev / sensitivity``, with
    the sample deviation and at least two earlier days, so a higher sensitivity flags more
    days. The window runs over one row per day.
    """
    daily = df.groupBy(F.col(day_col).alias("day")).agg(F.count(F.lit(1)).alias("row_count"))
    w = Window.orderBy("day").rowsBetween(-look_back, -1)
    mean, dev, n = F.avg("row_count").over(w), F.stddev_samp("row_count").over(w), F.count("day").over(w)
    return daily.select(
        "day",
        "row_count",
        mean.alias("trailing_mean"),
        dev.alias("trailing_stddev"),
        (
            (n >= 2) & (F.abs(F.col("row_count") - mean) > dev * (2 / sensitivity))
        ).alias("is_anomaly"),
    )


def run_checks(
    tables: Mapping[str, DataFrame], checks: Sequence[Check], as_of: dt.datetime
) -> DataFrame:
    """Evaluate all checks and return the report. Unknown columns raise before anything runs."""
    _validate(tables, checks)
    parts: list[DataFrame] = []
    for name in dict.fromkeys(c.table for c in checks):
        df = tables[name]
        scalar = [c for c in checks if c.table == name and c.kind in SCALAR]
        if scalar:
            row = df.agg(*[F.expr(f"{_scalar(c, as_of)} as c{i}") for i, c in enumerate(scalar)])
            parts.append(row.selectExpr(_entries([(c, f"c{i}") for i, c in enumerate(scalar)])))
        for c in (c for c in checks if c.table == name and c.kind not in SCALAR):
            count = "count(1)"
            if c.kind == "duplicates":
                hits = duplicate_keys(df, c.columns, c.where)
            elif c.kind == "orphans":
                hits = orphan_keys(df, tables[c.parent], c.columns[0], c.parent_key)
                count = "coalesce(sum(row_count), 0)"
            elif c.kind == "anomaly":
                hits = rowcount_anomalies(df, c.columns[0], **c.options).where("is_anomaly")
            else:
                raise ValueError(f"unknown check kind {c.kind}")
            parts.append(hits.agg(F.expr(f"{count} as n")).selectExpr(_entries([(c, "n")])))
    return union_frames(parts)


def write_checks(
    tables: Mapping[str, DataFrame], checks: Sequence[Check], as_of: dt.datetime
) -> DataFrame:
    """The report of ``run_checks``, with each table's checks run and written as a job of their own.

    As one plan, all tables' broadcasts, stages and threads meet on the driver, and nothing is
    freed before the last check; adaptive execution also records the whole plan again with every
    stage that ends, so what the driver keeps grows with the square of the plan.
    """
    _validate(tables, checks)
    names = list(dict.fromkeys(c.table for c in checks))
    spark = tables[names[0]].sparkSession
    path = work_path(spark, "quality-report")

    def write(name: str) -> str:
        own = [c for c in checks if c.table == name]
        run_checks(tables, own, as_of).write.parquet(f"{path}/{name}")
        return f"{path}/{name}"

    with measured_broadcasts(spark), ThreadPoolExecutor(AT_ONCE) as pool:
        written = list(pool.map(write, names))
    return spark.read.schema(REPORT).parquet(*written)


def gate(report: DataFrame) -> None:
    """Raise when any check failed. The report has one row per check, so reading the failed
    ones is bounded by the number of checks."""
    failed = report.where(F.col("status") == "fail").collect()
    if failed:
        lines = [f"{r.table_name}.{r.column_name} {r.check_name}={r.observed}" for r in failed]
        raise QualityError("; ".join(sorted(lines)))


def require_rows(**tables: DataFrame) -> None:
    """Fail loudly when an input that must not be empty is empty."""
    empty = [name for name, df in tables.items() if df.isEmpty()]
    if empty:
        raise QualityError(f"empty input: {', '.join(empty)}")
