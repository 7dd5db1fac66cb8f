"""Product codes of vectors, with codebooks refined by rounds that LAESA pivots prune.

Vectors become integers and are cut into equal parts; a part position has a codebook of its own.
A few pivots per part position are fixed once, and every part's distances to them are computed
once and stored beside its components. In each round only the distances from pivots to entries
are new: by the triangle inequality |d(part, pivot) - d(pivot, entry)| is a lower bound of the
distance from part to entry. Entries are tried in the order of that bound, distances are exact
integers, and an entry whose bound lies above the best distance so far is never evaluated.

What leaves a task in a round is one sum per part position, entry and component, so a round moves
as much data however many vectors there are, and the codebooks are small for the same reason.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewharf.llm.base import Scratch

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
PIVOTS = 6
#: Scaled components from here on could overflow a long as summed squares.
LARGEST = 1 << 27
#: Vectors whose bounds are held at once.
BLOCK_ROWS = 4096
#: Entries tried one after the other before all that are left are evaluated together.
ORDERED = 2
#: More than the error of a stored distance, in parts of the largest distance met.
ROUNDING = 1e-5


def integers(vectors: DataFrame, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """vec_id, label, x (array<long>) of the vectors that have only finite components.

    A null vector, or one with a null, infinite, NaN or too large component (scaled, 2^27 or
    more) is left out, as is one that cannot be cut into equal parts.
    """
    x = F.col("embedding")
    scaled = F.transform(x, lambda v: v.cast("double") * scale)
    fine = F.forall(scaled, lambda v: F.coalesce(F.abs(v) < LARGEST, F.lit(False)) & ~F.isnan(v))
    whole = (F.size(x) > 0) & (F.size(x) % parts == 0)
    return vectors.where(x.isNotNull() & whole & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.transform(scaled, lambda v: F.floor(v)).alias("x")
    )


def first_codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """(part, entry, component) of the smallest vec_ids, at most ``entries`` rows. Repeated ids are
    taken in the order of their components, null ids last. Vectors are as long as the first."""
    def order() -> list[Column]:
        return [F.col("vec_id").asc_nulls_last(), F.col("x")]

    one = kept.select("vec_id", "x").orderBy(*order()).limit(1).collect()
    if not one:
        return np.empty((parts, 0, 1), np.int64)
    long = kept.where(F.size("x") == len(one[0].x)).select("vec_id", "x")
    rows = np.array([r.x for r in long.orderBy(*order()).limit(entries).collect()], np.int64)
    return np.ascontiguousarray(rows.reshape(len(rows), parts, -1).transpose(1, 0, 2))


def choose_pivots(codebooks: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """(part, pivot, component): from each first codebook the entry farthest from those before."""
    out = []
    for book in codebooks:
        picked = [0]
        near = ((book - book[0]) ** 2).sum(1)
        while len(picked) < min(pivots, len(book)):
            picked.append(int(near.argmax()))
            near = np.minimum(near, ((book - book[picked[-1]]) ** 2).sum(1))
        out.append(book[picked])
    return np.stack(out)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``a`` to those of ``b``."""
    return np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(2).astype(np.float64))


def _measure(pivots: np.ndarray) -> Callable:
    """Vectors to packed components and packed distances to the pivots."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                block = batch.slice(at, BLOCK_ROWS)
                x = block.column("x").flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(len(block), -1)
                cut = x.astype(np.int64).reshape(len(block), len(pivots), -1)
                far = np.stack([_distances(cut[:, j], p) for j, p in enumerate(pivots)], 1).astype("<f4")
                packed = [pa.array([r.tobytes() for r in rows], pa.binary()) for rows in (x, far)]
                yield pa.RecordBatch.from_arrays([block.column("vec_id"), block.column("label"), *packed], names=["vec_id", "label", "x", "far"])

    return run


def nearest(x: np.ndarray, far: np.ndarray, book: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(entry, squared distance, evaluations) of each part ``x`` whose pivot distances are ``far``.
    Ties go to the lower entry."""
    to = _distances(book, pivots).astype(np.float32)
    bound = np.zeros((len(x), len(book)), np.float32)
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(far[:, p, None] - to[None, :, p]), out=bound)
    slack = ROUNDING * (1 + max(float(far.max(initial=0)), float(to.max(initial=0))))
    bound = np.maximum(bound - slack, 0).astype(np.float64) ** 2
    best = np.full(len(x), np.iinfo(np.int64).max)
    entry = np.full(len(x), len(book))
    rows, tried = np.arange(len(x)), 0
    for _ in range(min(ORDERED, len(book))):
        at = bound[rows].argmin(1)
        open_ = bound[rows, at] <= best[rows]
        rows, at = rows[open_], at[open_]
        d = ((x[rows] - book[at]) ** 2).sum(1)
        tried += len(rows)
        better = (d < best[rows]) | ((d == best[rows]) & (at < entry[rows]))
        best[rows[better]], entry[rows[better]] = d[better], at[better]
        bound[rows, at] = np.inf
    rows, at = np.nonzero(bound <= best[:, None])
    if len(rows):
        d = ((x[rows] - book[at]) ** 2).sum(1)
        tried += len(rows)
        order = np.lexsort((at, d, rows))
        rows, at, d = rows[order], at[order], d[order]
        lead = np.r_[True, rows[1:] != rows[:-1]]
        rows, at, d = rows[lead], at[lead], d[lead]
        better = (d < best[rows]) | ((d == best[rows]) & (at < entry[rows]))
        best[rows[better]], entry[rows[better]] = d[better], at[better]
    return entry, best, tried


def _blocks(batches: Iterable[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, len(batch), BLOCK_ROWS):
            block = batch.slice(at, BLOCK_ROWS)
            if len(block):
                x = np.frombuffer(b"".join(block.column("x").to_pylist()), "<i4").astype(np.int64)
                far = np.frombuffer(b"".join(block.column("far").to_pylist()), "<f4")
                yield block, x.reshape(len(block), parts, -1), far.reshape(len(block), parts, -1)


def _sums(books: np.ndarray, pivots: np.ndarray) -> Callable:
    """One task's sums: part, entry, component, members, total."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.shape
        members, total = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for _, x, far in _blocks(batches, parts):
            for j in range(parts):
                entry, _, _ = nearest(x[:, j], far[:, j], books[j], pivots[j])
                members[j] += np.bincount(entry, minlength=entries)
                np.add.at(total[j], entry, x[:, j])
        part, entry = np.nonzero(members)
        rows = [np.repeat(part, width), np.repeat(entry, width), np.tile(np.arange(width), len(part)), np.repeat(members[part, entry], width), total[part, entry].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], names=["part", "entry", "position", "members", "total"])

    return run


def refine(measured: DataFrame, books: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each entry is the floor of the mean of its parts, an unused
    entry stays. The driver gets one row per part position, entry and component."""
    sums = measured.select("x", "far").mapInArrow(_sums(books, pivots), "part long, entry long, position long, members long, total long")
    found = sums.groupBy("part", "entry", "position").agg(F.sum("members").alias("members"), F.sum("total").alias("total")).collect()
    out = books.copy()
    for r in found:
        out[r.part, r.entry, r.position] = r.total // r.members
    return out


def _codes(books: np.ndarray, pivots: np.ndarray) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, x, far in _blocks(batches, len(books)):
            code, error = np.empty((len(x), len(books)), np.uint8), np.zeros(len(x), np.int64)
            for j in range(len(books)):
                entry, d, _ = nearest(x[:, j], far[:, j], books[j], pivots[j])
                code[:, j] = entry
                error += d
            packed = pa.array([c.tobytes() for c in code], pa.binary())
            yield pa.RecordBatch.from_arrays([block.column("vec_id"), block.column("label"), packed, pa.array(error)], names=["vec_id", "label", "code", "error"])

    return run


def encode(
    vectors: DataFrame, scratch: Scratch, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS
) -> tuple[np.ndarray, DataFrame]:
    """(codebooks, codes): the codebooks as (part, entry, component), and vec_id, label, code (one
    byte per part), error (squared distance to the coded vector), as a written table.

    ``vectors`` has vec_id, embedding, label. Only vectors as long as the one of the smallest
    vec_id are coded, besides what ``integers`` leaves out. Repeated rows are coded each; with
    fewer than ``entries`` vectors the codebooks are as small. No vectors give no codes.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte per part")
    kept = integers(vectors, parts)
    books = first_codebooks(kept, parts, entries)
    if not books.size:
        return books, kept.select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(0).cast("long").alias("error")).limit(0)
    fixed = choose_pivots(books, pivots)
    kind = dict(kept.dtypes)["label"]
    same = kept.where(F.size("x") == parts * books.shape[2])
    measured = scratch.cut(same.mapInArrow(_measure(fixed), f"vec_id long, label {kind}, x binary, far binary"), "measured")
    for _ in range(rounds):
        books = refine(measured, books, fixed)
    codes = measured.mapInArrow(_codes(books, fixed), f"vec_id long, label {kind}, code binary, error long")
    return books, scratch.cut(codes, "codes")


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all components in order, decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def report(vectors: DataFrame) -> DataFrame:
    """One row per coded vector. Sums per label are joined back, so a hot label stays splittable."""
    books, codes = encode(vectors, Scratch(vectors.sparkSession, "vector-codes"))
    sums = codes.groupBy(F.col("label").alias("_tw_label")).agg(F.sum("error").alias("label_error"))
    joined = codes.join(sums, codes.label.eqNullSafe(sums._tw_label))
    return joined.select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256")
    )


def _sql() -> str:
    def assigned(book: str) -> str:
        return f"""select vec_id, label, part, x, min({{'d': d, 'e': e}}) as n from (
        select p.vec_id, p.label, p.part, p.x, c.e,
            list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.y[i]) * (p.x[i] - c.y[i]))) as d
        from p join {book} c using (part)) group by vec_id, label, part, x"""

    def updated(book: str, found: str) -> str:
        return f"""select c.part, c.e, coalesce(m.y, c.y) as y from {book} c left join (
        select part, e, list(cast((s - ((s % k) + k) % k) // k as bigint) order by i) as y from (
            select part, n.e as e, i, sum(x[i]) as s, count(*) as k from {found}, unnest(range(1, len(x) + 1)) u(i) group by part, n.e, i)
        group by part, e) m using (part, e)"""

    return f"""
with v as (
    select vec_id, label, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as c
    from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (
    select vec_id, label, part, c[part * (len(c) // {PARTS}) + 1 : (part + 1) * (len(c) // {PARTS})] as x
    from v, unnest(range({PARTS})) u(part)),
b0 as (
    select part, row_number() over (partition by part order by vec_id) - 1 as e, x as y from p
    where vec_id in (select vec_id from v order by vec_id limit {ENTRIES})),
a0 as ({assigned("b0")}),
b1 as ({updated("b0", "a0")}),
a1 as ({assigned("b1")}),
b2 as ({updated("b1", "a1")}),
a2 as ({assigned("b2")}),
o as (
    select vec_id, label, string_agg(lpad(lower(hex(n.e)), 2, '0'), '' order by part) as code, cast(sum(n.d) as bigint) as error
    from a2 group by vec_id, label)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
    (select sha256(string_agg(array_to_string(y, ','), ',' order by part, e)) from b2) as codebooks_sha256
from o
"""


SQL = _sql()
