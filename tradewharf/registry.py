"""Named tables and how each is built from others."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Model:
    """One table of the lakehouse. ``materialized`` is view, table or incremental."""

    name: str
    layer: str
    deps: tuple[str, ...]
    build: Callable[..., DataFrame]
    materialized: str = "table"
    keys: tuple[str, ...] = ()
    watermark: str | None = None
    per: str | None = None
    month_of: str | None = None
    uses_as_of: bool = False


MODELS: dict[str, Model] = {}


def model(name: str, layer: str, deps: Iterable[str] = (), **options):
    """Register ``build(*dependency_frames)`` under ``name``."""

    def add(build):
        MODELS[name] = Model(name, layer, tuple(deps), build, **options)
        return build

    return add


def layer_schema(layer: str) -> str:
    """Schema name of a layer as given, trimmed and in upper case."""
    return layer.strip().upper()


def dependency_order(names: Iterable[str], given: Iterable[str] = ()) -> list[str]:
    """``names`` and what they need, dependencies first; ``given`` tables are not expanded."""
    order: list[str] = []
    known = set(given)

    def visit(name: str) -> None:
        if name in order or name in known or name not in MODELS:
            return
        for dep in MODELS[name].deps:
            visit(dep)
        order.append(name)

    for name in names:
        visit(name)
    return order


class Lake:
    """Resolves table names to lazy DataFrames.

    ``sources`` maps names to frames (or zero-argument callables). A name found there wins
    over the model of that name, so an already materialized table replaces its computation.
    """

    def __init__(
        self,
        spark: SparkSession,
        sources: Mapping[str, DataFrame | Callable[[], DataFrame]],
        as_of: dt.date | None = None,
    ):
        self.spark = spark
        self.as_of = as_of
        self._sources = dict(sources)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._resolve(name)
        return self._built[name]

    def __contains__(self, name: str) -> bool:
        return name in self._sources or name in MODELS

    def with_tables(self, **tables: DataFrame) -> Lake:
        return Lake(self.spark, {**self._sources, **tables}, self.as_of)

    def _resolve(self, name: str) -> DataFrame:
        if name in self._sources:
            source = self._sources[name]
            return source() if callable(source) else source
        if name not in MODELS:
            raise KeyError(f"unknown table {name!r}: neither a source nor a model")
        m = MODELS[name]
        frames = [self[d] for d in m.deps]
        return m.build(*frames, as_of=self.as_of) if m.uses_as_of else m.build(*frames)


def table(
    spark: SparkSession,
    name: str,
    sources: Mapping[str, DataFrame | Callable[[], DataFrame]],
    as_of: dt.date | None = None,
) -> DataFrame:
    """One table by name."""
    from tradewharf import plans  # noqa: F401  (registers the models)

    return Lake(spark, sources, as_of)[name]
