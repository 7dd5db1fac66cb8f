"""File sources and sinks: day partitions, VARIANT landing, flattening, ledgers, registry."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewharf.operators.incremental import write_partitioned
from tradewharf.schemas import LANDED, SELECTED_STREAMS


def export_partitions(
    df: DataFrame, date_col: str, out_dir: str, day: dt.date | None = None, part: Column | None = None
) -> None:
    """Write rows below ``out_dir/dt=<date>/``: one day, or every day present.

    Partitions are replaced, never appended, so a rerun gives the same files' content; a day
    without rows touches nothing. The day filter compares the raw column with a literal and
    is pushed to the source. ``part`` overrides the partition value (for example the month).
    """
    if day is not None:
        df = df.where(F.col(date_col) == F.lit(day))
    value = (part if part is not None else F.col(date_col)).cast("date")
    write_partitioned(df.withColumn("dt", value), out_dir, "dt")


def full_refresh(df: DataFrame, path: str) -> DataFrame:
    """Replace a small table as a whole."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_lake(df: DataFrame, root: str, stream: str, date_col: str) -> DataFrame:
    """Raw lake layout: one folder per stream, partitioned by ``execution_date``."""
    path = f"{root}/raw/{stream}"
    write_partitioned(df.withColumn("execution_date", F.col(date_col).cast("date")), path, "execution_date")
    return df.sparkSession.read.parquet(path)


def land_variant(df: DataFrame, loaded_at: Column, file_name: Column | None = None) -> DataFrame:
    """Pack whole rows into one VARIANT column with their lineage."""
    name = file_name if file_name is not None else F.col("_metadata.file_path")
    return df.select(
        F.to_variant_object(F.struct("*")).alias("raw_data"),
        name.alias("_file_name"),
        loaded_at.cast("timestamp_ntz").alias("_loaded_at"),
    )


def land_json(df: DataFrame, text_col: str, loaded_at: Column, file_name: Column) -> DataFrame:
    """Land JSON text; text that does not parse gives a NULL payload."""
    return df.select(
        F.try_parse_json(text_col).alias("raw_data"),
        file_name.alias("_file_name"),
        loaded_at.cast("timestamp_ntz").alias("_loaded_at"),
    )


def flatten_variant(df: DataFrame, payload: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Typed columns out of ``raw_data`` plus ``_loaded_at`` and ``_file_name``.

    ``strict`` raises on a value that does not fit its type; otherwise it becomes NULL (see
    ``split_bad_casts`` for keeping such rows apart). Absent fields are NULL either way.
    """
    get = F.variant_get if strict else F.try_variant_get
    return df.select(
        *[get("raw_data", f"$.{c}", t).alias(c) for c, t in payload.items()],
        "_loaded_at",
        "_file_name",
    )


def split_bad_casts(df: DataFrame, payload: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): a row is quarantined when a declared field holds a value that
    does not fit its type. Quarantined rows keep the payload and name the bad fields."""
    # Two reads of the payload: every field by its type, and every field as text. Inlining a
    # one-element array makes them columns that later filters refer to instead of repeat.
    typed = ", ".join(f"{c}: {t}" for c, t in payload.items())
    text = ", ".join(f"{c}: string" for c in payload)
    read = df.selectExpr(
        "raw_data", "_file_name", "_loaded_at",
        "inline(array(named_struct("
        f"'_typed', try_variant_get(raw_data, '$', 'struct<{typed}>'), "
        f"'_text', try_variant_get(raw_data, '$', 'struct<{text}>'))))",
    )
    bad = ", ".join(
        f"case when _text.{c} is not null and _typed.{c} is null then '{c}' end"
        for c, t in payload.items()
        if t != "string"
    )
    marked = read.withColumn("bad_fields", F.expr(f"concat_ws(',', {bad})")).drop("_text")
    good = marked.where("bad_fields = ''").select("_typed.*", "_loaded_at", "_file_name")
    return good, marked.where("bad_fields <> ''").drop("_typed")


def land_heavy_tables(
    tables: Mapping[str, DataFrame], root: str, loaded_at: Column, file_name: Column
) -> dict[str, str]:
    """Land every table of the fixed list of heavy tables below ``root/<domain>/<table>``.

    ``tables`` is keyed ``domain.table``. All of them must be there: a missing one is named
    before anything is written.
    """
    wanted = {f"{s.domain}.{s.table}": s for s in LANDED}
    missing = sorted(set(wanted) - set(tables))
    if missing:
        raise ValueError(f"heavy tables missing: {', '.join(missing)}")
    paths = {}
    for name, spec in wanted.items():
        paths[name] = f"{root}/{spec.domain}/{spec.table}"
        landed = land_variant(tables[name], loaded_at, file_name)
        landed.write.mode("append").parquet(paths[name])
    return paths


def require_streams(available: Iterable[str]) -> tuple[str, ...]:
    """The replicated streams; an error names those that are not available."""
    missing = sorted(set(SELECTED_STREAMS) - set(available))
    if missing:
        raise ValueError(f"selected streams missing: {', '.join(missing)}")
    return SELECTED_STREAMS


def file_ledger(
    df: DataFrame, columns: Sequence[str], loaded_at: Column, file_col: str = "_file_name"
) -> DataFrame:
    """One row per file: file_name, checksum of its rows' ``columns``, loaded_at.

    The checksum has the row count and the sum of the row hashes, so it does not depend on the
    order of the rows and is summed up before the shuffle.
    """
    rows = F.count(F.lit(1)).cast("string")
    total = F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).cast("string")
    return df.groupBy(F.col(file_col).alias("file_name")).agg(F.concat_ws("-", rows, total).alias("checksum")).withColumn(
        "loaded_at", loaded_at
    )


def load_new_files(
    df: DataFrame,
    ledger: DataFrame,
    file_col: str = "_file_name",
    columns: Sequence[str] = (),
    as_of: dt.datetime | None = None,
    keep_days: int = 64,
) -> DataFrame:
    """Rows of files the ledger does not list yet. The ledger has one row per load of a file.

    With ``columns`` a file counts as listed only under the same checksum (see ``file_ledger``),
    so a file that was sent again with other content is loaded again, as a whole. With
    ``as_of`` entries older than ``keep_days`` are forgotten.
    """
    if as_of is not None:
        ledger = ledger.where(F.col("loaded_at") >= F.lit(as_of - dt.timedelta(days=keep_days)))
    if not columns:
        seen = ledger.select(F.col("file_name").alias("_seen")).distinct()
        return df.join(seen, F.col(file_col) == F.col("_seen"), "left_anti")
    sent = file_ledger(df, columns, F.lit(None).cast("timestamp_ntz"), file_col).drop("loaded_at")
    wanted = sent.join(ledger.select("file_name", "checksum"), ["file_name", "checksum"], "left_anti")
    return df.join(wanted.select(F.col("file_name").alias("_wanted")), F.col(file_col) == F.col("_wanted"), "left_semi")


def landing_profile(
    raw: DataFrame, key: str, date_col: str, system_col: str, like: str
) -> DataFrame:
    """Row count, distinct keys and date range of landed rows of matching systems.

    In ``like``, ``_`` stands for any one character.
    """
    return (
        raw.select(
            F.try_variant_get("raw_data", f"$.{key}", "string").alias("k"),
            F.try_variant_get("raw_data", f"$.{date_col}", "date").alias("d"),
            F.try_variant_get("raw_data", f"$.{system_col}", "string").alias("s"),
        )
        .where(F.col("s").like(like))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("k").alias("distinct_keys"),
            F.min("d").alias("min_date"),
            F.max("d").alias("max_date"),
        )
    )


def reconcile_counts(source: DataFrame, target: DataFrame, day_col: str) -> DataFrame:
    """Rows per day on both sides; a day missing on one side counts 0 there."""
    both = source.select(F.col(day_col).alias("day"), F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
        target.select(F.col(day_col).alias("day"), F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    return both.groupBy("day").agg(
        F.sum("s").alias("source_count"), F.sum("t").alias("target_count")
    ).withColumn("is_equal", F.col("source_count") == F.col("target_count"))


def content_sums(df: DataFrame, by: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """Rows and an order-free checksum of ``columns`` per group. Hashes are added, not combined bit
    by bit, so a repeated row counts as often as it is there."""
    code = F.xxhash64(*columns).cast("decimal(38,0)")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(code).alias("code"))


def _unequal(source: DataFrame, target: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Groups whose rows or checksum are not the same on both sides."""
    sides = [content_sums(df, [F.col(c) for c in by], columns).withColumn("sign", F.lit(s)) for df, s in ((source, 1), (target, -1))]
    both = sides[0].unionByName(sides[1]).groupBy(*by)
    sums = both.agg(F.sum(F.col("n") * F.col("sign")).alias("n"), F.sum(F.col("code") * F.col("sign")).alias("code"))
    return sums.where("n <> 0 or code <> 0").select(*by)


def reconcile_content(source: DataFrame, target: DataFrame, day_col: str, keys: Sequence[str], buckets: int = 256) -> DataFrame:
    """What differs between two copies of a table, key by key: day, the keys, and ``state``
    (missing, extra or changed in ``target``).

    Checksums go down a tree: per day first, then per bucket of keys inside the days that differ,
    and only rows of buckets that differ are compared. Days are literals, so the scans of the lower
    levels leave out equal ones; equal copies are read once. A key that moved to another day is
    missing on one and extra on the other. Repeated keys are compared as sets of rows. NULL days
    and keys are values like others. Columns that only one side has are not compared.
    """
    columns = [c for c in source.columns if c in target.columns]
    bucket = F.pmod(F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]), F.lit(buckets))
    sides = [df.select(*columns).withColumnRenamed(day_col, "day") for df in (source, target)]
    named = ["day" if c == day_col else c for c in columns]
    # At most as many values as the tables have days.
    days = [r[0] for r in _unequal(*sides, ["day"], named).collect()]
    among = F.coalesce(F.col("day").isin([v for v in days if v is not None]), F.lit(False))
    among = among | F.col("day").isNull() if None in days else among
    sides = [df.where(among).withColumn("_bucket", bucket) for df in sides]
    where = _unequal(*sides, ["day", "_bucket"], named).withColumnsRenamed({"day": "_day", "_bucket": "_b"})
    same = F.col("day").eqNullSafe(F.col("_day")) & (F.col("_bucket") == F.col("_b"))
    by = list(dict.fromkeys(["day", *["day" if k == day_col else k for k in keys]]))
    rows = [
        content_sums(df.join(where, same, "left_semi"), [F.col(c) for c in by], named).withColumns({"s": F.lit(1 - t), "t": F.lit(t), "sign": F.lit(1 - 2 * t)})
        for t, df in enumerate(sides)
    ]
    found = rows[0].unionByName(rows[1]).groupBy(*by).agg(
        F.max("s").alias("s"), F.max("t").alias("t"), F.sum(F.col("n") * F.col("sign")).alias("n"), F.sum(F.col("code") * F.col("sign")).alias("code"),
    )
    state = F.when(F.col("t") == 0, "missing").when(F.col("s") == 0, "extra").otherwise("changed")
    return found.where("n <> 0 or code <> 0").select(*by, state.alias("state"))


def read_registry(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Employee registry from JSON files; every field is text."""
    return spark.read.schema(schema).json(path)


def filter_registry(people: DataFrame, **equals: str | None) -> DataFrame:
    """Optional equality filters; a None value means no filter."""
    for col, value in equals.items():
        if value is not None:
            people = people.where(F.col(col) == value)
    return people


def lookup_person(people: DataFrame, id_number: str) -> DataFrame:
    """The person with this identity number; no row when unknown."""
    return people.where(F.col("id_number") == id_number)


def surrogate_id(key: Column, modulus: int = 10_000_000) -> Column:
    """Repeatable numeric id of a text key. Collisions are possible: never merge on it."""
    return F.pmod(F.xxhash64(key), F.lit(modulus))


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"source lacks columns: {', '.join(missing)}")
    return df.select(*columns)
