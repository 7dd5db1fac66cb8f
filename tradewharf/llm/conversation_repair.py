"""Cheapest repair of the turn structure of conversations.

A conversation's turns become symbols, one for each combination of role and fault that edits treat
alike. Re-Pair (``grammar``) compresses the symbol sequences of a batch of conversations together.
Every symbol has a min-plus transfer matrix: from each state of the role grammar to each other,
the least cost of edits and, as a rope, the least of the audits with that cost. A rule's matrix is
the product of its two symbols' matrices, computed once, bottom-up, for all conversations of the
batch; a conversation is the product of what is left of it.

Matrices are associative, so a conversation may be cut anywhere. Turns are sorted by ranges; what
lies whole inside a range is repaired there, and the conversations at the ends of a range, or longer
than a piece, are written as pieces: duplicates are found by grouping, every piece gets its matrix,
and the pieces of a conversation meet only as small matrices. So no task holds a conversation.

Audits of one stretch of turns have one letter other than I per turn and end in one, because
inserted turns belong to the turn after them. So no audit of equal cost is the beginning of
another, and the least audit of a whole is put together from least audits of its stretches.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewharf.llm import grammar
from tradewharf.llm.base import Scratch

#: States of the role grammar `(s?(ua)+)?`: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: state -> initial of a role -> next state
STEPS = {START: {"s": AFTER_S, "u": AFTER_U}, AFTER_S: {"u": AFTER_U}, AFTER_U: {"a": AFTER_A}, AFTER_A: {"u": AFTER_U}}
#: The role an inserted or re-roled turn takes in a state.
NEXT_ROLE = {START: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
#: Inserted turns at the end, by the state reached.
TAIL = {START: "", AFTER_S: "II", AFTER_U: "I", AFTER_A: ""}
LEGAL = {"su", "ua", "au"}

#: Turns and characters a piece may hold, turns of a batch that share a grammar, places of a rule.
PIECE_ROWS, PIECE_CHARS, BATCH_ROWS, LEAST = 4096, 4_000_000, 50_000, 4
#: Text bytes of a range.
RANGE_BYTES = 64_000_000

SAID = re.compile(r"[^\x20\x09-\x0D]")
ENDS = (".", "!", "?")

FACTS = "blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long"
WHOLE = f"conv_id long, {FACTS}, cost long, audit string"
REPAIRED = "array<struct<role: string, text: string>>"
ROWS = "array<struct<turn: long, role: string, text: string>>"


class Rope:
    """A string as a tree; equal parts are known by length and hash."""

    __slots__ = ("n", "code", "power", "left", "right", "text")
    BASE, PRIME = 1_000_003, (1 << 61) - 1

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None) -> None:
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.n, self.code, self.power = len(text), 0, pow(self.BASE, len(text), self.PRIME)
            for c in text:
                self.code = (self.code * self.BASE + ord(c)) % self.PRIME
        else:
            self.n = left.n + right.n
            self.code = (left.code * right.power + right.code) % self.PRIME
            self.power = left.power * right.power % self.PRIME

    def __add__(self, other: Rope) -> Rope:
        return other if not self.n else self if not other.n else Rope("", self, other)

    def __str__(self) -> str:
        out, open_ = [], [self]
        while open_:
            x = open_.pop()
            if x.left is None:
                out.append(x.text)
            else:
                open_ += [x.right, x.left]
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        """In ASCII order; stretches that are equal on both sides are passed over whole."""
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x is y or (x.n == y.n and x.code == y.code):
                continue
            if x.left is None and y.left is None:
                k = min(x.n, y.n)
                if x.text[:k] != y.text[:k]:
                    return x.text[:k] < y.text[:k]
                a += [Rope(x.text[k:])] if x.n > k else []
                b += [Rope(y.text[k:])] if y.n > k else []
            elif y.left is None or (x.left is not None and x.n >= y.n):
                a += [x.right, x.left]
                b.append(y)
            else:
                b += [y.right, y.left]
                a.append(x)
        return bool(b) and not a


#: from state -> to state -> (cost, audit)
Matrix = list[dict[int, tuple[int, Rope]]]


def _put(row: dict, state: int, cost: int, audit: Rope) -> None:
    known = row.get(state)
    if known is None or cost < known[0] or (cost == known[0] and audit < known[1]):
        row[state] = cost, audit


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = []
    for row in a:
        new: dict = {}
        for mid, (cost, audit) in row.items():
            for state, (more, rest) in b[mid].items():
                known = new.get(state)
                if known is None or cost + more <= known[0]:
                    _put(new, state, cost + more, audit + rest)
        out.append(new)
    return out


IDENTITY: Matrix = [{i: (0, Rope())} for i in range(4)]


def _turn_matrix(initial: str, lost: bool, cut_off: bool) -> Matrix:
    """Inserted turns before, then what may be done with the turn itself."""
    out: Matrix = []
    for begin in range(4):
        row: dict = {}
        state, cost, audit = begin, 0, ""
        for _ in range(3):  # a third inserted turn leads back to a state already reached
            _put(row, state, cost + DELETE, Rope(audit + "D"))
            if not lost:
                if initial in STEPS[state]:
                    _put(row, STEPS[state][initial], cost + CUT_OFF * cut_off, Rope(audit + "K"))
                _put(row, STEPS[state][NEXT_ROLE[state][0]], cost + REROLE + CUT_OFF * cut_off, Rope(audit + "R"))
            state, cost, audit = STEPS[state][NEXT_ROLE[state][0]], cost + INSERT, audit + "I"
        out.append(row)
    return out


#: Symbols: 0 a turn that must go; then initial s, u, a or another, sound or cut off; last the barrier.
INITIALS = "sua "
SYMBOLS = [_turn_matrix("", True, False), *[_turn_matrix(i, False, c) for i in INITIALS for c in (False, True)]]
BARRIER = len(SYMBOLS)


def matrices(sequences: list[list[int]], least: int = LEAST) -> Iterator[Matrix]:
    """The matrix of each symbol sequence; all share one grammar and the matrices of its rules."""
    joined = np.array([s for seq in sequences for s in [*seq, BARRIER]], np.int64)
    g = grammar.compress(joined, BARRIER + 1, least, BARRIER)
    known: list = [*SYMBOLS, None]
    for left, right in g.rules.tolist():
        known.append(product(known[left], known[right]))
    now = None
    for symbol in g.sequence.tolist():
        if symbol == BARRIER:
            yield IDENTITY if now is None else now
            now = None
        else:
            now = known[symbol] if now is None else product(now, known[symbol])


def cheapest(pieces: list[Matrix]) -> tuple[int, list[tuple[int, str]], str]:
    """(cost, state before and audit of each piece, inserted tail) of pieces in order. Backward by
    cost to go; then forward, where only steps of least cost compete by their audits."""
    to_go = [{s: INSERT * len(t) for s, t in TAIL.items()}]
    for m in reversed(pieces):
        to_go.append({i: min((c + to_go[-1][j] for j, (c, _) in row.items()), default=0) for i, row in enumerate(m)})
    to_go.reverse()
    state, out = START, []
    for k, m in enumerate(pieces):
        best = None
        for j, (cost, audit) in m[state].items():
            if cost + to_go[k + 1][j] == to_go[k][state] and (best is None or audit < best[0]):
                best = audit, j
        out.append((state, str(best[0])))
        state = best[1]
    return to_go[0][START], out, TAIL[state]


def apply_audit(rows: list[dict], state: int, audit: str) -> list[dict]:
    """The turns after the edits; ``state`` is the one before the first turn."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            role, text = rows[at]["role"], rows[at]["text"]
        else:
            role, text = NEXT_ROLE[state], "" if edit == "I" else rows[at]["text"]
        at += edit != "I"
        state = STEPS[state][role[0]]
        out.append({"role": role, "text": text})
    return out


def _is_blank(text: str) -> bool:
    return SAID.search(text) is None


def _examine(rows: list[dict], copies: set[int] | None = None) -> tuple[dict, list[int]]:
    """(facts, symbols) of turns in order. ``copies`` are the places of duplicates where earlier
    turns lie elsewhere; without it they are found here."""
    facts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "first": None, "last": None}
    seen, symbols = set(), []
    for place, row in enumerate(rows):
        role, text = row["role"], row["text"]
        again = (role, text) in seen if copies is None else place in copies
        if copies is None:
            seen.add((role, text))
        initial = role[:1]
        if place and facts["last"] + initial not in LEGAL:
            facts["illegal"] += 1
        facts["last"] = initial
        if place == 0:
            facts["first"] = initial
        if _is_blank(text):
            facts["blank"] += 1
            symbols.append(0)
        elif again:
            facts["duplicate"] += 1
            symbols.append(0)
        else:
            cut_off = not text.rstrip(" \t\n\x0b\f\r").endswith(ENDS)
            facts["truncated"] += cut_off
            kind = INITIALS.find(initial) if initial and initial != " " else 3
            symbols.append(1 + 2 * (kind if kind >= 0 else 3) + cut_off)
    turns = {r["turn"] for r in rows if r["turn"] is not None}
    facts |= {"low": min(turns, default=None), "high": max(turns, default=None), "turns": len(turns)}
    return facts, symbols


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


_FACTS = [(n, pa.string() if n in ("first", "last") else pa.int64()) for n in (f.split()[0] for f in FACTS.split(", "))]
_TURN = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_SAID = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_DEALT = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int64()), ("rows", pa.list_(_TURN)),
    *_FACTS, ("cost", pa.int64()), ("audit", pa.string()), ("repaired", _SAID),
])
DEALT = f"conv_id long, part int, piece long, rows {ROWS}, {FACTS}, cost long, audit string, repaired {REPAIRED}"


def _solved(held: list[tuple[int | None, list[dict]]], part: int) -> pa.RecordBatch:
    """Conversations that lie whole in one range."""
    found = [_examine(rows) for _, rows in held]
    out = []
    for (conv_id, rows), (facts, _), m in zip(held, found, matrices([s for _, s in found])):
        cost, [(state, audit)], tail = cheapest([m])
        out.append({
            "conv_id": conv_id, "part": part, "piece": None, "rows": None, **facts, "cost": cost, "audit": audit + tail,
            "repaired": apply_audit(rows, state, audit + tail),
        })
    return _batch(out, _DEALT)


def _deal(batches: Iterable[pa.RecordBatch], piece_rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted turns of one range to repaired conversations, and to pieces of those that may go on
    beyond the range or exceed a piece. Pieces are numbered within the range."""
    held: list = []  # whole conversations waiting for their batch
    held_rows = held_chars = piece = part = 0
    rows: list[dict] = []
    chars, open_, now = 0, True, None  # the first conversation may have begun in the range before

    def cut() -> pa.RecordBatch:
        nonlocal rows, chars, piece
        out = _batch([{"conv_id": now[0], "part": part, "piece": piece, "rows": rows}], _DEALT)
        rows, chars, piece = [], 0, piece + 1
        return out

    for batch in batches:
        names = ("conv_id", "part", "gone", "turn", "role", "text")
        for conv_id, part, gone, turn, role, text in zip(*(batch.column(c).to_pylist() for c in names)):
            if now != (conv_id,):
                if now is not None:
                    if open_:
                        yield cut()
                    else:
                        held.append((now[0], rows))
                        held_rows, held_chars = held_rows + len(rows), held_chars + chars
                        rows, chars = [], 0
                        if held_rows >= BATCH_ROWS or held_chars >= PIECE_CHARS:
                            yield _solved(held, part)
                            held, held_rows, held_chars = [], 0, 0
                    open_ = False
                now = (conv_id,)
            if not gone:
                rows.append({"turn": turn, "role": role, "text": text})
                chars += len(role) + len(text)
                if len(rows) >= piece_rows or chars >= PIECE_CHARS:
                    open_ = True
                    yield cut()
    if now is not None:
        yield cut()  # the last one may go on in the next range
    if held:
        yield _solved(held, part)


_MEASURED = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int64()), *_FACTS,
    ("paths", pa.list_(pa.struct([("i", pa.int64()), ("j", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]))),
])
MEASURED = f"conv_id long, part int, piece long, {FACTS}, paths array<struct<i: long, j: long, cost: long, audit: string>>"


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with the places of their duplicates to facts and matrices."""
    for batch in batches:
        for at in range(0, len(batch), 16):
            pieces = batch.slice(at, 16).to_pylist()
            found = [_examine(p["rows"], set(p["copies"] or ())) for p in pieces]
            out = []
            for p, (facts, _), m in zip(pieces, found, matrices([s for _, s in found])):
                paths = [{"i": i, "j": j, "cost": c, "audit": str(a)} for i, row in enumerate(m) for j, (c, a) in row.items()]
                out.append({"conv_id": p["conv_id"], "part": p["part"], "piece": p["piece"], **facts, "paths": paths})
            yield _batch(out, _MEASURED)


_DECIDED = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int64()), ("state", pa.int64()), ("edits", pa.string()),
    *_FACTS, ("cost", pa.int64()), ("audit", pa.string()),
])
DECIDED = f"conv_id long, part int, piece long, state long, edits string, {FACTS}, cost long, audit string"


def _joined_facts(pieces: list[dict]) -> dict:
    out = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "first": None, "last": None, "low": None, "high": None, "turns": 0}
    for p in pieces:
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            out[name] += p[name]
        if p["first"] is not None:
            if out["last"] is None:
                out["first"] = p["first"]
            elif out["last"] + p["first"] not in LEGAL:
                out["illegal"] += 1
            out["last"] = p["last"]
        if p["low"] is not None:
            if out["high"] is None:
                out["low"] = p["low"]
            elif out["high"] == p["low"]:
                out["turns"] -= 1  # one turn number on both sides of a cut
            out["high"] = p["high"]
    return out


def _decide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matrices of a conversation's pieces in order to each piece's edits; the conversation's own
    facts, cost and audit are in the row of its last piece."""
    now, held = None, []

    def out() -> pa.RecordBatch:
        pieces: list[Matrix] = []
        for p in held:
            m: Matrix = [{} for _ in range(4)]
            for x in p["paths"]:
                m[x["i"]][x["j"]] = x["cost"], Rope(x["audit"])
            pieces.append(m)
        cost, steps, tail = cheapest(pieces)
        steps[-1] = steps[-1][0], steps[-1][1] + tail
        rows = [{"conv_id": p["conv_id"], "part": p["part"], "piece": p["piece"], "state": s, "edits": e} for p, (s, e) in zip(held, steps)]
        rows[-1] |= {**_joined_facts(held), "cost": cost, "audit": "".join(e for _, e in steps)}
        return _batch(rows, _DECIDED)

    for batch in batches:
        for row in batch.to_pylist():
            if now != (row["conv_id"],):
                if held:
                    yield out()
                now, held = (row["conv_id"],), []
            held.append(row)
    if held:
        yield out()


_APPLIED = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int64()), ("repaired", _SAID)])
APPLIED = f"conv_id long, part int, piece long, repaired {REPAIRED}"


def _apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(len(batch)):
            [p] = batch.slice(at, 1).to_pylist()
            repaired = apply_audit(p["rows"], p["state"], p["edits"])
            yield _batch([{"conv_id": p["conv_id"], "part": p["part"], "piece": p["piece"], "repaired": repaired}], _APPLIED)


def repair(turns: DataFrame, scratch: Scratch, piece_rows: int = PIECE_ROWS) -> tuple[DataFrame, DataFrame]:
    """(conversations, repaired): one row per conv_id of ``turns`` with the counts of its faults,
    the least cost and the least audit with that cost; and the repaired turns in pieces.

    ``turns`` has conv_id, turn, role, text and optionally gone (rows that only keep their
    conversation in the result). Turns are in the order of turn, role, text, nulls first. A null
    role or text is one space; rows without a conv_id form one conversation. ``repaired`` has
    conv_id, part, piece, repaired (array of role, text): in the order of part and piece the arrays
    follow each other. Conversations without turns have empty audits and no repaired turn. No rows
    give no rows.
    """
    gone = F.col("gone").cast("boolean") if "gone" in turns.columns else F.lit(False)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        F.coalesce(gone, F.lit(False)).alias("gone"),
    ).withColumns({"role": F.when(F.col("gone"), "").otherwise(F.col("role")), "text": F.when(F.col("gone"), "").otherwise(F.col("text"))})
    spark = turns.sparkSession
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = max(spark.sparkContext.defaultParallelism, -(-total // RANGE_BYTES))
    # Range borders are sampled, so their keys are short; equal beginnings stay in one range.
    order = ["conv_id", "turn", "role", F.substring("text", 1, 64)]
    sorted_ = rows.repartitionByRange(ranges, *order).sortWithinPartitions("conv_id", "turn", "role", "text")
    dealt = scratch.cut(sorted_.withColumn("part", F.spark_partition_id()).mapInArrow(partial(_deal, piece_rows=piece_rows), DEALT), "dealt")
    place = ["part", "piece"]
    whole, pieces = dealt.where("rows is null"), dealt.where("rows is not null").select("conv_id", *place, "rows")

    said = pieces.select("conv_id", *place, F.posexplode("rows").alias("at", "row"))
    key = F.sha2(F.concat(F.length("row.role").cast("string"), F.lit(":"), F.col("row.role"), F.lit(":"), F.col("row.text")), 256)
    said = said.select("conv_id", key.alias("key"), F.struct(*place, "at").alias("place"))
    first = said.groupBy(F.col("conv_id").alias("_tw_conv"), F.col("key").alias("_tw_key")).agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = said.join(first, said.conv_id.eqNullSafe(first._tw_conv) & (said.key == first._tw_key)).where("place <> first")
    copies = again.groupBy(F.col("place.part").alias("part"), F.col("place.piece").alias("piece")).agg(F.collect_list("place.at").alias("copies"))
    measured = scratch.cut(pieces.join(copies, place, "left").select("conv_id", *place, "rows", "copies").mapInArrow(_measure, MEASURED), "measured")
    decided = measured.repartition("conv_id").sortWithinPartitions("conv_id", *place).mapInArrow(_decide, DECIDED)
    decided = scratch.cut(decided, "decided")
    applied = pieces.join(decided.select(*place, "state", "edits"), place).mapInArrow(_apply, APPLIED)
    facts = ["conv_id", *[n for n, _ in _FACTS], "cost", "audit"]
    conversations = whole.select(*facts).unionByName(decided.where("audit is not null").select(*facts))
    return conversations, whole.select("conv_id", "part", F.lit(0).cast("long").alias("piece"), "repaired").unionByName(applied)


DIGEST = "conv_id long, repaired_sha256 string"


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation, streamed over its pieces in order."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    now, state, begun = None, hashlib.sha256(), False
    for batch in batches:
        done = []
        for conv_id, n, body in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "n", "body"))):
            if now != (conv_id,):
                if now is not None:
                    done.append({"conv_id": now[0], "repaired_sha256": state.hexdigest()})
                now, state, begun = (conv_id,), hashlib.sha256(), False
            if n:
                state.update((("\n" if begun else "") + body).encode())
                begun = True
        if done:
            yield _batch(done, schema)
    if now is not None:
        yield _batch([{"conv_id": now[0], "repaired_sha256": state.hexdigest()}], schema)


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its repaired turns, `role:text` joined by line ends."""
    body = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    rows = repaired.select("conv_id", "part", "piece", F.size("repaired").alias("n"), body.alias("body"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").select("conv_id", "n", "body").mapInArrow(_digests, DIGEST)


def damage(turns: DataFrame) -> DataFrame:
    """Known faults by the checksum of `conv_id:turn` modulo 20: 0 drops the turn (``gone``), 1
    empties its text, 2 takes its `.!?`, 3 repeats it, 4 makes it the user's. Nulls are one space."""
    def shown(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = turns.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
        (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20).alias("_tw_draw"))
    text = F.when(F.col("_tw_draw") == 1, "").when(F.col("_tw_draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    hit = rows.select(
        "conv_id", "turn", F.when(F.col("_tw_draw") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("_tw_draw") == 0).alias("gone"), F.explode(F.when(F.col("_tw_draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_tw_copy"),
    )
    return hit.drop("_tw_copy")


def report(turns: DataFrame) -> DataFrame:
    """One row per conversation after damage, from what the repair returned."""
    found, repaired = repair(damage(turns.select("conv_id", "turn", "role", "text")), Scratch(turns.sparkSession, "conversation-repair"))
    hashes = digests(repaired).withColumnRenamed("conv_id", "_tw_conv")
    return found.join(hashes, found.conv_id.eqNullSafe(hashes._tw_conv)).select(
        "conv_id", F.coalesce(F.expr("high - low + 1 - turns"), F.lit(0)).cast("long").alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    )
