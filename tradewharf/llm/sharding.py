"""Sharding by a keyed permutation of the global row numbers.

Rows get gapless global numbers, an alternating Feistel network over Z_a x Z_b permutes them,
and cycle walking leads the few values beyond the last row back into range. Shard and slot
follow from the new position by division, so they can be computed for any row number.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARDS = 24
SEED = "shuffle-1"
ROUNDS = 6
PRIME = 2_147_483_647
#: Groups that rows are numbered in; each is one sort of a task.
BLOCKS = 4096


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def checksum(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")))


def number_rows(rows: DataFrame, blocks: int = BLOCKS) -> tuple[DataFrame, int]:
    """(``rows`` plus ``_tw_row`` from 0 without gaps, their count).

    The order is a hash block of doc_id, doc_id, ``_tw_len``, ``_tw_crc``. It depends on the
    rows only, not on files or partitions. The counts per block come from the id column alone.
    """
    head = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 8)
    block = F.pmod(F.conv(head, 16, 10).cast("long"), F.lit(blocks))
    counts = rows.select(block.alias("_tw_b")).groupBy("_tw_b").agg(F.count(F.lit(1)).alias("_tw_n"))
    # One row per block, a fixed number.
    sizes = {r["_tw_b"]: r["_tw_n"] for r in counts.collect()}
    starts, total = [], 0
    for b in range(blocks):
        starts.append(total)
        total += sizes.get(b, 0)
    order = Window.partitionBy("_tw_b").orderBy("doc_id", "_tw_len", "_tw_crc")
    before = F.element_at(F.from_json(F.lit(str(starts)), "array<long>"), (F.col("_tw_b") + 1).cast("int"))
    numbered = rows.withColumn("_tw_b", block).withColumn("_tw_row", F.row_number().over(order).cast("long") - 1 + before)
    return numbered.drop("_tw_b"), total


def factors(n: int) -> tuple[int, int]:
    """a, b with a * b >= n, both near the root, and few values beyond n."""
    root = max(1, math.isqrt(max(n, 1) - 1) + 1)
    a = min(range(max(1, root - min(63, root // 4)), root + 1), key=lambda a: (-(-n // a) * a - n, -a))
    return a, max(1, -(-n // a))


def round_keys(seed: str, rounds: int = ROUNDS) -> list[tuple[int, int, int, int]]:
    out = []
    for r in range(rounds):
        d = hashlib.sha256(f"{seed}/{r}".encode()).digest()
        out.append(tuple(1 + int.from_bytes(d[4 * i : 4 * i + 4], "big") % (PRIME - 1) for i in range(4)))
    return out


def feistel(x: str, n: int, seed: str = SEED) -> str:
    """SQL of one pass of the permutation of 0 .. a * b - 1 over the expression ``x``."""
    a, b = factors(n)
    keys = ", ".join(
        f"named_struct('even', {'true' if i % 2 == 0 else 'false'}, 'm', {m}L, 'k', array({k0}L, {k1}L, {k2}L))"
        for i, (m, k0, k1, k2) in enumerate(round_keys(seed))
    )
    # The round function squares twice modulo a prime, so that nothing exceeds 63 bits.
    mix = f"aggregate(slice(k.k, 2, 2), (if(k.even, s.r, s.l) % {PRIME}L * (k.m % 2097152L) + k.k[0]) % {PRIME}L, (t, c) -> (t * t + c) % {PRIME}L)"
    return (
        f"aggregate(array({keys}), named_struct('l', {x} % {a}L, 'r', {x} div {a}L), "
        f"(s, k) -> named_struct('l', if(k.even, (s.l + {mix}) % {a}L, s.l), 'r', if(k.even, s.r, (s.r + {mix}) % {b}L)), "
        f"s -> s.r * {a}L + s.l)"
    )


def permute(rows: DataFrame, number: str, n: int, out: str, seed: str = SEED) -> DataFrame:
    """Position ``out`` in 0 .. n-1 for the row number ``number``; a bijection.

    Beyond n lie a * b - n values. A walk from inside meets each at most once, so that many
    further passes always end it; only the few rows that leave the range take them.
    """
    a, b = factors(n)
    rows = rows.withColumn("_tw_y", F.expr(feistel(number, n, seed)))
    walk = F.col("_tw_y")
    if a * b > n:
        again = f"aggregate(sequence(1, {a * b - n}), _tw_y, (z, i) -> if(z < {n}L, z, {feistel('z', n, seed)}))"
        walk = F.expr(f"if(_tw_y < {n}L, _tw_y, {again})")
    return rows.withColumn(out, walk).drop("_tw_y")


def place(rows: DataFrame, n_shards: int, seed: str) -> DataFrame:
    """``rows`` (doc_id, _tw_len, _tw_crc, ...) plus shard and slot."""
    numbered, n = number_rows(rows)
    placed = permute(numbered, "_tw_row", max(n, 1), "_tw_at", seed)
    return placed.withColumns({
        "shard": F.pmod("_tw_at", F.lit(n_shards)).cast("int"), "slot": F.expr(f"_tw_at div {n_shards}L"),
    }).drop("_tw_row", "_tw_at")


def assign(docs: DataFrame, n_shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """``docs`` plus shard and slot: shard sizes differ by one row at most, slots are gapless.

    Rows are told apart by doc_id, length and checksum of the text; rows equal in all three
    share their set of places, whichever takes which. Null ids come first in their block, null
    texts count as empty. No rows give no rows.
    """
    rows = docs.withColumns({"_tw_len": size_of(F.col("text")), "_tw_crc": checksum(F.col("text"))})
    return place(rows, n_shards, seed).drop("_tw_len", "_tw_crc")


def report(docs: DataFrame) -> DataFrame:
    """One row per document; the law is ``rows``. Texts are read once and not shuffled."""
    rows = docs.select("doc_id", size_of(F.col("text")).alias("_tw_len"), checksum(F.col("text")).alias("_tw_crc"))
    return place(rows, SHARDS, SEED).select(
        "doc_id", (F.col("_tw_len") + 8).alias("size"), F.col("_tw_crc").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
