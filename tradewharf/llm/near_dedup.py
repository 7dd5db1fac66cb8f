"""Near-duplicates by min-max hashing.

Each of 64 permutations of the 64-bit shingle hashes gives two values of the signature, the
minimum and the maximum, so 128 values cost 64 evaluations per shingle. 32 bands of four values
propose links; a link is confirmed on the full shingle sets. At the threshold of 0.8 a pair
shares no band with probability (1 - 0.8 ** 4) ** 32, below 1e-7.

Equal sets are one class from the start. Within a bucket every class is compared with the
smallest one first; what that leaves unconnected is compared across the parts that remain, so a
bucket of n near copies costs n comparisons, not n squared. Parts are compared by their rarest
shingles: sets as similar as the threshold share one of the first 20 % of their shingles in any
common order, here that of their frequency, so texts that have only a passage in common do not
meet, and no proposed link between different components goes untested.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType
from pyspark.sql.window import Window

from tradewharf.llm.base import Scratch, row_key
from tradewharf.llm.graph import components

#: Words of a shingle: op8's contract fixes four; the pipeline's stage has none and takes five.
SHINGLE, STAGE_SHINGLE = 4, 5
PERCENT = 80
PERMUTATIONS, BANDS = 64, 32
#: Bytes of text hashed at once.
CHUNK = 1_000_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_random = np.random.Generator(np.random.Philox(20240101))
_BYTE = _random.integers(1, 2**64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_MULTIPLY = _random.integers(0, 2**63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _random.integers(0, 2**64, PERMUTATIONS, np.uint64)
_BAND = _random.integers(0, 2**63, (BANDS, 4), np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

SIGNATURE_SCHEMA = "doc_id long, _tw_text long, n long, s1 long, s2 long, bands array<long>"
SET_SCHEMA = "doc_id long, _tw_set binary"


def _power(kind: str, n: int) -> np.ndarray:
    """Powers of the base, or of its inverse, modulo 2**64."""
    if len(_powers[kind]) < n:
        steps = np.full(max(n, 2 * CHUNK), _BASE if kind == "up" else _INVERSE)
        steps[0] = 1
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles: runs of ``words`` words, or the
    whole sequence of fewer. A hash is a polynomial of the run's bytes, taken from prefix sums."""
    rows = [b" ".join((t or "").encode().translate(_LOWER).split()) for t in texts]
    out: list[np.ndarray] = []
    for row in rows:
        if not row:
            out.append(np.empty(0, np.uint64))
            continue
        data = np.frombuffer(row, np.uint8)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _power("up", len(data)), out=sums[1:])
        blanks = np.flatnonzero(data == 32)
        starts = np.concatenate(([0], blanks + 1))
        ends = np.concatenate((blanks, [len(data)]))
        k = min(words, len(starts))
        starts, ends = starts[: len(starts) - k + 1], ends[k - 1 :]
        hashes = (sums[ends] - sums[starts]) * _power("down", len(data))[starts]
        out.append(np.unique(_mix(hashes + (ends - starts).astype(np.uint64))))
    return out


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(sets x 2 sums that name a set, sets x bands) of non-empty sets."""
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])))[:-1]
    values = np.concatenate(sets)
    sums = np.stack([np.add.reduceat(_mix(values + np.uint64(i)), starts) for i in (1, 2)], 1)
    bands = np.zeros((len(sets), BANDS), np.uint64)
    for i in range(PERMUTATIONS):
        turned = values * _MULTIPLY[i]
        turned += _ADD[i]
        band, at = divmod(2 * i, 4)
        for j, extreme in enumerate((np.minimum, np.maximum)):
            bands[:, band] += _mix(extreme.reduceat(turned, starts)) * _BAND[band, at + j]
    return sums, _mix(bands)


def _chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > CHUNK:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def _lists(rows: np.ndarray) -> pa.ListArray:
    n, k = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k, dtype=np.int32)), pa.array(rows.astype(np.int64).ravel()))


Batches = Iterator[pa.RecordBatch]


def _sign(words: int) -> Callable[[Batches], Batches]:
    def sign(batches: Batches) -> Batches:
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("_tw_text")
            texts = batch.column("text").to_pylist()
            for a, b in _chunks([len(t or "") for t in texts]):
                sets = shingle_sets(texts[a:b], words)
                n = np.array([len(s) for s in sets], np.int64)
                sums, bands = (np.zeros((b - a, k), np.uint64) for k in (2, BANDS))
                if n.any():
                    sums[n > 0], bands[n > 0] = signatures([s for s in sets if len(s)])
                signed = sums.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), keys.slice(a, b - a), pa.array(n), pa.array(signed[:, 0].copy()), pa.array(signed[:, 1].copy()), _lists(bands)],
                    names=["doc_id", "_tw_text", "n", "s1", "s2", "bands"],
                )

    return sign


def _to_sets(words: int) -> Callable[[Batches], Batches]:
    def to_sets(batches: Batches) -> Batches:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _chunks([len(t or "") for t in texts]):
                sets = pa.array([s.tobytes() for s in shingle_sets(texts[a:b], words)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), sets], names=["doc_id", "_tw_set"])

    return to_sets


def _explode_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("_tw_set").to_pylist()):
            shingles = np.frombuffer(raw, np.int64)
            ids, sizes = np.full(len(shingles), doc_id), np.full(len(shingles), len(shingles))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(shingles), pa.array(sizes)], names=["doc_id", "shingle", "n"])


@F.pandas_udf(BooleanType())
def _linked(left: pd.Series, right: pd.Series) -> pd.Series:
    def one(x: bytes, y: bytes) -> bool:
        if 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
            return False
        a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = np.concatenate((a, b))
        both.sort(kind="stable")
        common = int(np.count_nonzero(both[1:] == both[:-1]))
        return 100 * common >= PERCENT * (len(a) + len(b) - common)

    return pd.Series([one(x, y) for x, y in zip(left, right)], dtype=bool)


def full_sets(ids: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Shingle sets of the given documents, from their texts."""
    return texts.join(ids, "doc_id").mapInArrow(_to_sets(words), SET_SCHEMA)


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of document ids whose full shingle sets are similar enough."""
    left = pairs.join(sets.withColumnsRenamed({"doc_id": "a", "_tw_set": "_tw_a"}), "a")
    both = left.join(sets.withColumnsRenamed({"doc_id": "b", "_tw_set": "_tw_b"}), "b")
    return both.where(_linked("_tw_a", "_tw_b")).select("a", "b")


def split_buckets(spots: DataFrame, key: str) -> DataFrame:
    """``spots`` (key, rep, component, ...) of the keys with several components, plus ``main``,
    the component with most rows there: it is never compared within itself."""
    sizes = spots.groupBy(key, "component").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy(key).agg(F.max_by("component", F.struct("k", "component")).alias("main"), F.count(F.lit(1)).alias("k"))
    return spots.join(main.where("k > 1").select(key, "main"), key)


def rare_shingles(sets: DataFrame) -> DataFrame:
    """doc_id, shingle, n, at: the shingles by which a set can meet another, the rarest
    n - ceil(0.8 n) + 1, without those that occur once, and their places in the order."""
    each = sets.mapInArrow(_explode_sets, "doc_id long, shingle long, n long")
    shared = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    order = Window.partitionBy("doc_id").orderBy("df", "shingle")
    ranked = each.join(shared, "shingle").withColumns({
        "at": F.row_number().over(order), "many": F.count(F.lit(1)).over(Window.partitionBy("doc_id")),
    })
    placed = ranked.withColumn("at", F.expr("n - many + at"))
    return placed.where(f"at <= n - ({PERCENT} * n + 99) div 100 + 1").select("doc_id", "shingle", "n", "at")


def across_parts(parts: DataFrame, spots: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of different components that may be links, out of buckets with several."""
    def placed(rows: DataFrame) -> DataFrame:
        named = rows.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
        return named.withColumn("component", F.coalesce("component", "rep"))

    open_ids = split_buckets(placed(spots.select("rep", "spot")), "spot").select(F.col("rep").alias("doc_id")).distinct()
    open_sets = sets.join(scratch.cut(open_ids, "open"), "doc_id")
    rare = placed(rare_shingles(open_sets).withColumnRenamed("doc_id", "rep"))
    met = scratch.cut(split_buckets(rare, "shingle"), "met")
    rest = met.where("component <> main").select("shingle", F.col("rep").alias("a"), "n", "at", F.col("component").alias("ca"))
    others = met.select("shingle", F.col("rep").alias("b"), F.col("n").alias("m"), F.col("at").alias("to"), F.col("component").alias("cb"), "main")
    # At the first shingle that two sets share, what follows it must make up the whole overlap.
    enough = f"{100 + PERCENT} * (1 + least(n - at, m - to)) >= {PERCENT} * (n + m)"
    like = f"ca <> cb and (cb = main or a > b) and 100 * least(n, m) >= {PERCENT} * greatest(n, m) and {enough}"
    return rest.alias("l").join(others.alias("r"), F.expr(f"l.shingle = r.shingle and {like}")).select("a", "b").distinct()


def classes(docs: DataFrame, scratch: Scratch, words: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(members: doc_id, _tw_text, n, rep; links between reps: a, b) of all rows with an id."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    keyed = texts.withColumn("_tw_text", row_key(F.col("text")))
    signed = scratch.cut(keyed.mapInArrow(_sign(words), SIGNATURE_SCHEMA), "signatures")
    name = ["s1", "s2", "n"]
    reps = signed.where("n > 0").groupBy(*name).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    reps = scratch.cut(reps, "reps")
    members = signed.drop("bands").join(reps.select(*name, "rep"), name, "left").select(
        "doc_id", "_tw_text", "n", F.coalesce("rep", "doc_id").alias("rep")
    )
    spots = reps.select("rep", F.explode("bands").alias("spot"))
    buckets = spots.groupBy("spot").agg(F.min("rep").alias("lead"), F.count(F.lit(1)).alias("k")).where("k > 1")
    spots = scratch.cut(spots.join(buckets.select("spot", "lead"), "spot"), "spots")
    firsts = scratch.cut(spots.where("rep <> lead").select(F.col("rep").alias("a"), F.col("lead").alias("b")).distinct(), "firsts")
    ids = spots.select(F.col("rep").alias("doc_id")).distinct()
    sets = scratch.cut(full_sets(ids, texts, words), "sets")
    links = scratch.cut(confirm(firsts, sets), "links")
    pairs = across_parts(components(links, scratch, "part"), spots, sets, scratch)
    tested = firsts.select("a", "b").unionByName(firsts.select(F.col("b").alias("a"), F.col("a").alias("b")))
    seconds = scratch.cut(pairs.join(tested, ["a", "b"], "left_anti"), "seconds")
    more = scratch.cut(confirm(seconds, sets), "more")
    return members, links.unionByName(more)


def near_duplicates(docs: DataFrame, scratch: Scratch, words: int = SHINGLE) -> DataFrame:
    """doc_id, _tw_text, n_shingles, component_id, kept: one row per row of ``docs``, compared on
    shingles of ``words`` words.

    A text without words has no shingles and is linked with nothing. Rows without a doc_id are
    linked with nothing, have no component and are kept. doc_id is taken to be unique; equal
    rows share a component. No rows give no rows.
    """
    members, links = classes(docs, scratch, words)
    found = components(links, scratch, "whole")
    out = members.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", "_tw_text", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id")
    )
    out = out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    unnamed = docs.where("doc_id is null").select(
        F.lit(None).cast("long").alias("doc_id"), row_key(F.col("text")).alias("_tw_text"),
        F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"),
    )
    return out.unionByName(unnamed)


def filter_documents(docs: DataFrame, words: int = STAGE_SHINGLE) -> DataFrame:
    """One document of each group, with its own columns; of equal rows one stays."""
    scratch = Scratch(docs.sparkSession, "near-dedup")
    kept = near_duplicates(docs, scratch, words).where("kept and doc_id is not null").select(F.col("doc_id").alias("_tw_id"), "_tw_text").distinct()
    kept = scratch.cut(kept.withColumnRenamed("_tw_text", "_tw_kept"), "kept")
    keyed = docs.withColumn("_tw_text", row_key(F.col("text")))
    joined = keyed.join(kept, (keyed.doc_id == kept._tw_id) & (keyed._tw_text == kept._tw_kept))
    one = joined.dropDuplicates(["_tw_id", "_tw_kept"]).select(*docs.columns)
    return one.unionByName(docs.where("doc_id is null"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document with its set size, component and whether it stays."""
    return near_duplicates(docs.select("doc_id", "text"), Scratch(docs.sparkSession, "near-dedup"), SHINGLE).drop("_tw_text")
