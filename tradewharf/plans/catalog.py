"""Registered queries: every model of the lakehouse over one folder of test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewharf import plans  # noqa: F401  (registers the models)
from tradewharf.plans.catalog_operators import OPERATOR_QUERIES
from tradewharf.registry import MODELS
from tradewharf.schemas import LANDED_BY_STAGED
from tradewharf.sources.driver_tables import DriverTables

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame) -> DataFrame:
    """Ratios to six places, so that engines agree on the last bits of a quotient."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(c, 6) for c in doubles}) if doubles else df


def last_trade_date(tables: DriverTables) -> dt.date:
    return tables.read("orders").agg(F.max("o_orderdate").cast("date").alias("d")).first()["d"]


def _model_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = DriverTables(spark, sf_dir)
        if name in LANDED_BY_STAGED:
            return tables.landed_lake()[name]
        as_of = last_trade_date(tables) if MODELS[name].uses_as_of else None
        return rounded(tables.lake(as_of)[name])

    return run


def model_queries() -> dict[str, Query]:
    # The history needs captured states; it is registered with the history operators.
    return {n: _model_query(n) for n in MODELS if n != "dim_customer_history"}


def all_queries() -> dict[str, Query]:
    return {**model_queries(), **OPERATOR_QUERIES}
