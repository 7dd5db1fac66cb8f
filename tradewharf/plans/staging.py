"""Silver layer: 23 pass-through projections and 11 flattened, deduplicated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewharf.operators.relational import dedup_latest
from tradewharf.registry import model
from tradewharf.schemas import LANDED, PASSTHROUGH, Landed
from tradewharf.sources.files import flatten_variant, select_columns


def stage_select(source: str, columns: list[str]):
    def build(df: DataFrame) -> DataFrame:
        return select_columns(df, columns)

    return build


def stage_variant(spec: Landed):
    """Typed rows of a landed table, the latest landed version of each natural key."""

    def build(raw: DataFrame) -> DataFrame:
        typed = flatten_variant(raw, spec.payload)
        return dedup_latest(typed, spec.keys, ["_loaded_at"], ["_file_name"]).drop("_file_name")

    return build


def stage_employee(df: DataFrame) -> DataFrame:
    """The registry sends dates as text; they become dates here."""
    out = select_columns(df, PASSTHROUGH["hr.employee"].split())
    return out.withColumns({c: F.try_to_date(F.col(c)) for c in ("start_date", "end_date")})


for _source, _columns in PASSTHROUGH.items():
    _domain, _table = _source.split(".")
    _build = stage_employee if _source == "hr.employee" else stage_select(_source, _columns.split())
    model(f"stg_{_domain}__{_table}", f"STG_{_domain}", [_source])(_build)

for _spec in LANDED:
    model(
        _spec.staged,
        f"STG_{_spec.domain}",
        [_spec.raw],
        materialized="incremental",
        keys=_spec.keys,
        watermark="_loaded_at",
    )(stage_variant(_spec))
