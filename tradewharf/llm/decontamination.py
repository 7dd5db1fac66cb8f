"""Benchmark decontamination: one Aho-Corasick automaton over all windows of the test items.

Texts are scanned once. The automaton works on the normalised text (words between single
blanks); the word boundaries lead every match back to offsets of the original text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tradewharf.llm.base import Scratch

WINDOW = 10
#: Bytes of test items in one automaton, which bounds its memory: a megabyte of items measured
#: 335 MB in each Python worker and 55 MB of windows in the broadcast. More items are scanned in
#: several passes.
BLOCK_BYTES = 1_000_000

#: UTF-8 bytes: A-Z to lower case, all other ASCII but digits and letters to a blank.
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

_RESULT = StructType(
    [
        StructField("n_words", LongType()),
        StructField("n_hit", LongType()),
        StructField("item_ids", ArrayType(LongType())),
        StructField("hit_starts", ArrayType(LongType())),
        StructField("hit_ends", ArrayType(LongType())),
        StructField("marks", ArrayType(LongType())),
    ]
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_NORMAL).split()


def windows_of(text: str | None, window: int) -> set[bytes]:
    words = words_of(text)
    if not words:
        return set()
    last = max(len(words) - window, 0)
    return {b" ".join(words[i : i + window]) for i in range(last + 1)}


def _automaton(patterns: dict[bytes, tuple[int, ...]]) -> ahocorasick.Automaton:
    # Latin-1 gives one character per byte, so offsets in the automaton are byte offsets.
    machine = ahocorasick.Automaton()
    for p, ids in patterns.items():
        machine.add_word(f" {p.decode('latin-1')} ", (len(p) + 2, ids))
    machine.make_automaton()
    return machine


_machines: dict[str, ahocorasick.Automaton] = {}


def _merged(marks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping ranges joined; ranges start and end at blanks."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(marks):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _original(text: str, joined: str, marks: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Offsets of the ranges, in code points of the original text."""
    raw = text.encode()
    spans = [m.span() for m in _WORD.finditer(raw)]
    starts, ends, at_byte, at_char, word, seen = [], [], 0, 0, 0, 0

    def char(byte: int) -> int:
        nonlocal at_byte, at_char
        at_char += len(raw[at_byte:byte].decode())
        at_byte = byte
        return at_char

    for s, e in marks:
        word += joined.count(" ", seen, s)
        n = joined.count(" ", s, e)
        starts.append(char(spans[word][0]))
        ends.append(char(spans[word + n - 1][1]))
        word, seen = word + n, e
    return starts, ends


def scan(text: str | None, machine: ahocorasick.Automaton, old_marks=(), old_ids=()) -> tuple:
    words = words_of(text)
    if not words:
        return 0, 0, [], [], [], []
    joined = f" {b' '.join(words).decode('latin-1')} "
    marks, ids = list(zip(old_marks[::2], old_marks[1::2])), set(old_ids)
    for end, (length, items) in machine.iter(joined):
        marks.append((end - length + 1, end))
        ids.update(items)
    if not marks:
        return len(words), 0, [], [], [], []
    marks = _merged(marks)
    starts, ends = _original(text, joined, marks)
    n_hit = sum(joined.count(" ", s, e) for s, e in marks)
    return len(words), n_hit, sorted(ids), starts, ends, [x for m in marks for x in m]


def _scanner(broadcast, key: str):
    @F.pandas_udf(_RESULT)
    def find(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        if key not in _machines:
            _machines.clear()
            _machines[key] = _automaton(broadcast.value)
        machine = _machines[key]
        for texts, marks, ids in batches:
            rows = [
                scan(t, machine, () if m is None else np.asarray(m).tolist(), () if i is None else np.asarray(i).tolist())
                for t, m, i in zip(texts, marks, ids)
            ]
            yield pd.DataFrame(rows, columns=_RESULT.names)

    return find


def pattern_blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[dict[bytes, tuple[int, ...]]]:
    """Windows and the items they come from, in blocks of about ``block_bytes`` of items.

    The driver and each task hold one block at a time.
    """
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    items = benchmark.groupBy("text").agg(F.collect_set(F.col("item_id").cast("long")).alias("ids"))
    for b in range(blocks):
        out: dict[bytes, set[int]] = {}
        for row in items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).toLocalIterator():
            for p in windows_of(row["text"], window):
                out.setdefault(p, set()).update(row["ids"])
        yield {p: tuple(sorted(ids)) for p, ids in out.items()}


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` plus n_words, n_hit, item_ids, hit_starts, hit_ends (code points of ``text``).

    A null or wordless text has no words and no hits; an item without words has no window; an
    item without an id marks words but is not listed. Repeated rows are judged one by one;
    an empty ``benchmark`` marks nothing. No text is shuffled.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    none = F.lit(None).cast("array<long>")
    out = docs.withColumns({"_tw_marks": none, "_tw_ids": none})
    cut = None
    for b, patterns in enumerate(pattern_blocks(benchmark.select("item_id", "text"), window, block_bytes)):
        if b:
            # The next block starts from a written table, so only one automaton is in memory.
            out = scratch.cut(out, f"pass{b}")
            if cut:
                scratch.drop(cut)
            cut = f"pass{b}"
        if not patterns:
            patterns = {b"": ()}
        find = _scanner(spark.sparkContext.broadcast(patterns), uuid.uuid4().hex)
        out = out.withColumn("_tw_found", find("text", "_tw_marks", "_tw_ids"))
        out = out.withColumns({"_tw_marks": F.col("_tw_found.marks"), "_tw_ids": F.col("_tw_found.item_ids")})
    names = [f for f in _RESULT.names if f != "marks"]
    return out.withColumns({n: F.col(f"_tw_found.{n}") for n in names}).drop("_tw_found", "_tw_marks", "_tw_ids")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that no window of the benchmark occurs in, with their own columns."""
    found = decontaminate(docs.select(F.struct("*").alias("_tw_row"), "text"), benchmark, window)
    return found.where("n_hit = 0").select("_tw_row.*")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document, with the digest of the items found in it."""
    ids = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return decontaminate(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: Item windows meet document windows of the same length in an equi join.
SQL = r"""
with item_words as (
    select item_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
item_windows as (
    select distinct item_id, least(len(w), 10) as n, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') as g
    from (select *, unnest(range(greatest(len(w) - 9, 1))) as i from item_words where len(w) > 0)),
words as (
    select doc_id, row_number() over () as rid,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from documents),
spots as (
    select rid, i, n, array_to_string(w[i + 1 : i + n], ' ') as g
    from (select rid, w, n, unnest(range(len(w) - n + 1)) as i
          from words, (select distinct n from item_windows) where len(w) >= n)),
found as (select s.rid, s.i, s.n, t.item_id from spots s join item_windows t on s.n = t.n and s.g = t.g),
hits as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + n)) as p from found) group by rid),
items as (select rid, count(distinct item_id) as n_items,
        string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from found group by rid)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hits using (rid) left join items using (rid)
"""
