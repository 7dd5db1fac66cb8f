"""Token shards, conversation repair and vector codes against brute force and on awkward rows."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewharf.llm import base, catalog, conversation_repair, grammar, token_shards, vector_codes

SF_DIR = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"
VECTORS = "vec_id long, embedding array<float>, label int"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=300), st.integers(2, 5))
def test_grammar_gives_back_its_sequence(symbols, least):
    g = grammar.compress(np.array(symbols, np.int64), 4, least)
    assert g.expand(g.sequence).tolist() == symbols
    assert all(a < 4 + k and b < 4 + k for k, (a, b) in enumerate(g.rules.tolist()))
    assert [len(g.expand(np.array([4 + k]))) for k in range(len(g.rules))] == g.lengths.tolist()


def test_grammar_on_runs_and_copies():
    for symbols in ([1] * 1000, [1, 2, 3, 4, 5, 6, 7, 8, 9] * 500):
        g = grammar.compress(np.array(symbols), 10, 2)
        assert g.expand(g.sequence).tolist() == symbols and len(g.sequence) + 2 * len(g.rules) < 60
    g = grammar.compress(np.array([1, 0] * 100), 2, 2, barrier=0)
    assert len(g.rules) == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=2000), st.data())
def test_any_range_of_a_shard(ids, data):
    shard = token_shards.Shard(token_shards.pack_shard(np.array(ids * 3), 51, 2))
    first = data.draw(st.integers(0, len(ids) * 3 - 1))
    n = data.draw(st.integers(1, len(ids) * 3 - first))
    assert shard.n == len(ids) * 3 and shard.ids(first, n).tolist() == (ids * 3)[first : first + n]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_words_encode_like_whole_texts(texts):
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path(token_shards.VOCABULARY)
    whole = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        encoder = token_shards.encoder(f.read())
    got = [ids.tolist() for _, ids in encoder.encode(pa.array(texts, pa.string()), 1)]
    assert got == [[*whole.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def _expected_tokens(texts):
    from tokenizers import Tokenizer

    whole, start, out = Tokenizer.from_file(public_tokenizers.path(token_shards.VOCABULARY)), 0, {}
    for doc_id, text in sorted(texts.items()):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        out[doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def test_token_shards_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in base.table(spark, SF_DIR, "documents").collect()}
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in catalog.op11_token_shards(spark, SF_DIR).collect()}
    assert got == _expected_tokens(texts)


def test_documents_over_several_shards_and_random_access(spark):
    """Shards of 50 ids: long documents span many. A few index rows alone read the same ids."""
    docs = base.table(spark, SF_DIR, "documents").select("doc_id", "text")
    scratch = base.Scratch(spark, "token-shards-test")
    folder = scratch.folder("files")
    index = scratch.cut(token_shards.write_shards(docs, folder, public_tokenizers.path(token_shards.VOCABULARY), shard_ids=50, least=2), "index")
    assert index.where("size(pieces) > 5").count() > 0
    index = token_shards.placed(index)
    few = token_shards.read_ids(folder, index.where("doc_id % 17 = 3")).collect()
    want = _expected_tokens({r.doc_id: r.text for r in docs.collect()})
    assert len(few) > 5
    for r in few:
        assert (r.start, len(r.ids) // 4, zlib.crc32(r.ids)) == want[r.doc_id]


def test_edge_token_shards(spark, edge_docs, no_docs):
    rows = token_shards.report(edge_docs).collect()
    assert len(rows) == edge_docs.count() and token_shards.report(no_docs).count() == 0
    rows.sort(key=lambda r: r.start)
    assert rows[0].doc_id is None and [r.start for r in rows[1:]] == list(itertools.accumulate(r.n_tokens for r in rows[:-1]))
    got = {r.doc_id: r for r in rows}
    assert got[0].n_tokens == got[1].n_tokens == got[2].n_tokens == 1 and got[4].n_tokens == 30_001


def _damaged(rows):
    """Conversations after damage, in order; the contract in plain words."""
    out = {}
    for conv_id, turn, role, text in rows:
        shown = [" " if v is None else v for v in (conv_id, turn, role, text)]
        draw = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        kept = out.setdefault(conv_id, [])
        text = "" if draw == 1 else re.sub("[.!?]", "", shown[3]) if draw == 2 else shown[3]
        kept += [(turn, "user" if draw == 4 else shown[2], text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in out.items()}


def _repaired(turns):
    """All edits of all turns, state by state, keeping the least (cost, audit, result)."""
    legal = re.compile("(s?(ua)+)?")
    seen, counts, fates = set(), dict.fromkeys(("blank", "duplicate", "truncated"), 0), []
    for _, role, text in turns:
        said = re.sub("[\x20\x09-\x0d]", "", text)
        fate = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
        seen.add((role, text))
        if fate:
            counts[fate] += 1
        fates.append(fate)

    def next_states(best, edits):
        out = {}
        for (cost, audit, done), (more, letter, turn) in itertools.product(best.values(), edits):
            result = done + ((turn,) if turn else ())
            shape = "".join(r[:1] for r, _ in result)
            if not re.fullmatch("s?(ua)*u?", shape) or len(shape) != len(result):
                continue
            key = shape[-1:] if len(result) else ""
            new = (cost + more, audit + letter, result)
            if key not in out or new[:2] < out[key][:2]:
                out[key] = new
        return out

    def inserted(best):
        for _ in range(2):
            more = next_states(best, [(2, "I", ("user", "")), (2, "I", ("assistant", ""))])
            for key, value in more.items():
                if key not in best or value[:2] < best[key][:2]:
                    best[key] = value
        return best

    best = {"": (0, "", ())}
    for (_, role, text), fate in zip(turns, fates):
        edits = [(3, "D", None)]
        if fate not in ("blank", "duplicate"):
            extra = fate == "truncated"
            edits += [(extra, "K", (role, text)), (2 + extra, "R", ("user", text)), (2 + extra, "R", ("assistant", text))]
        best = next_states(inserted(best), edits)
    final = [v for v in inserted(best).values() if legal.fullmatch("".join(r[:1] for r, _ in v[2]))]
    cost, audit, result = min(final, key=lambda v: v[:2])
    initials = [r[:1] for _, r, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in result).encode()).hexdigest()
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)


def _check_repair(df, rows):
    got = {r.conv_id: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in df.collect()}
    want = {c: _repaired(t) for c, t in _damaged(rows).items()}
    assert got.keys() == want.keys()
    assert {c: (got[c], want[c]) for c in want if got[c] != want[c]} == {}


def _made_turns(seed, conversations=150):
    rng, rows = random.Random(seed), []
    for conv_id in [*range(conversations), None]:
        for turn in range(rng.randrange(0, 14)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "cut off", "", " \t", None, "Why? ", "fine.\n", f"text {turn}."])
            rows.append((conv_id, rng.choice([turn, turn, turn, turn + 2, None]), role, text))
    return rows


@pytest.mark.parametrize("piece_rows", [1, 3, 4096])
def test_conversation_repair_against_brute_force(spark, piece_rows):
    """Made turns with all kinds of faults, in pieces of one turn, of three, and whole."""
    rows = _made_turns(piece_rows)
    turns = conversation_repair.damage(spark.createDataFrame(rows, TURNS))
    found, repaired = conversation_repair.repair(turns, base.Scratch(spark, "repair-test"), piece_rows)
    hashes = conversation_repair.digests(repaired).withColumnRenamed("conv_id", "c")
    out = found.join(hashes, found.conv_id.eqNullSafe(hashes.c)).selectExpr("*", "coalesce(high - low + 1 - turns, 0) as gaps")
    _check_repair(out, rows)


def test_conversation_repair_query_against_brute_force(spark):
    rows = [tuple(r) for r in base.table(spark, SF_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    _check_repair(catalog.op12_conversation_repair(spark, SF_DIR), rows)


def test_edge_conversation_repair(spark):
    turns = spark.createDataFrame([], TURNS)
    assert conversation_repair.report(turns).count() == 0
    # 7:0 is dropped by its checksum if any turn is; a clashing column of the input is left out.
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    turns = spark.createDataFrame([(gone, 0, "user", "All gone.", 5)], TURNS + ", cost long")
    [row] = conversation_repair.report(turns).collect()
    assert (row.cost, row.audit, row.gaps, row.repaired_sha256) == (0, "", 0, hashlib.sha256(b"").hexdigest())


def test_one_long_conversation(spark):
    """Twenty thousand turns of one conversation go through pieces."""
    rows = [(1, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(20_000)]
    turns = spark.createDataFrame(rows, TURNS)
    found, repaired = conversation_repair.repair(turns, base.Scratch(spark, "repair-test"), 1000)
    [row] = found.collect()
    assert (row.cost, row.audit, row.illegal, row.turns) == (0, "K" * 20_000, 0, 20_000) and repaired.count() > 15


def _codes(rows, parts=16, entries=64, rounds=2):
    """Every distance of every part to every entry, with Python integers."""
    import math

    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v and not any(x is None or not math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: r[0])
    width = len(kept[0][1]) // parts
    cut = {i: [v[p * width : (p + 1) * width] for p in range(parts)] for i, v, _ in kept}
    books = [[cut[i][p] for i, _, _ in kept[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for i in cut:
                groups.setdefault(near(cut[i][p], books[p])[1], []).append(cut[i][p])
            for k, members in groups.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members)]
    out, totals = {}, {}
    for i, _, label in kept:
        found = [near(cut[i][p], books[p]) for p in range(parts)]
        out[i] = ["".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label]
        totals[label] = totals.get(label, 0) + out[i][1]
    text = ",".join(str(c) for book in books for e in book for c in e)
    return {i: (code, error, totals[label]) for i, (code, error, label) in out.items()}, hashlib.sha256(text.encode()).hexdigest()


def _check_codes(df, rows):
    want, digest = _codes(rows)
    got = df.collect()
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in got} == want and len(got) == len(want)
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_vector_codes_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([rng.gauss(0, 1), round(rng.gauss(0, 1))]) for _ in range(32)], rng.choice([1, 2, None])) for i in range(300)]
    rows = [(i, np.float32(v).tolist(), label) for i, v, label in rows]
    rows += [(1000 + i, rows[5][1], 9) for i in range(50)]  # repeated vectors tie everywhere
    bad = [(-1, None, 1), (-2, [None] * 32, 1), (-3, [float("nan")] * 32, 1), (-4, [*rows[0][1][:31], float("-inf")], 2), (-5, [], 1)]
    _check_codes(vector_codes.report(spark.createDataFrame(rows + bad, VECTORS)), rows + bad)


def test_few_or_no_vectors(spark):
    rows = [(i, [float(i)] * 16, 1) for i in range(3)]
    _check_codes(vector_codes.report(spark.createDataFrame(rows, VECTORS)), rows)
    assert vector_codes.report(spark.createDataFrame([(1, None, 1)], VECTORS)).count() == 0
    # Vectors that are not as long as the first are left out, as is what no long can hold.
    odd = [*rows, (7, [1.0] * 32, 1), (8, [1.0] * 15, 1), (9, [3e38] * 16, 1)]
    assert {r.vec_id for r in vector_codes.report(spark.createDataFrame(odd, VECTORS)).collect()} == {0, 1, 2}


def test_pivots_spare_evaluations():
    """Exact nearest entries with a part of the evaluations."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-3000, 3000, (64, 4))
    x = centres[rng.integers(0, 64, 5000)] + rng.integers(-90, 90, (5000, 4))
    pivots = vector_codes.choose_pivots(centres[None])[0]
    far = vector_codes._distances(x, pivots).astype(np.float32)
    entry, best, tried = vector_codes.nearest(x, far, centres, pivots)
    d = ((x[:, None] - centres[None]) ** 2).sum(2)
    assert (entry == d.argmin(1)).all() and (best == d.min(1)).all()
    assert tried < 5000 * 64 / 10


def test_remembered_words_are_looked_up_once():
    """One look-up a word that is remembered; older words and new ones come out alike."""

    class Counted(dict):
        n = 0

        def get(self, *key):
            Counted.n += 1
            return super().get(*key)

        def __contains__(self, key):
            Counted.n += 1
            return super().__contains__(key)

        def __getitem__(self, key):
            Counted.n += 1
            return super().__getitem__(key)

    with open(public_tokenizers.path(token_shards.VOCABULARY), encoding="utf-8") as f:
        encoder = token_shards.Encoder(f.read())
    words = ["alpha", "beta", "", "zyzzyx", "straße", "alpha"]
    want = [np.array(encoder.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    assert encoder._ids(words) == want
    encoder.words = Counted(encoder.words)
    assert encoder._ids(words) == want and Counted.n == len(words)
    encoder.older, encoder.words = dict(encoder.words), {}
    assert encoder._ids([*words, "gamma"])[:-1] == want and set(encoder.words) == {*words, "gamma"}


def _encoded(encoder, texts):
    import pyarrow as pa

    return [ids.tolist() for _, ids in encoder.encode(pa.array(texts, pa.string()), 1)]


def _word_encoder():
    with open(public_tokenizers.path(token_shards.VOCABULARY), encoding="utf-8") as f:
        return token_shards.Encoder(f.read())


def test_new_words_of_letters_are_encoded_many_to_a_text():
    """A few texts go to the tokenizer for a thousand new words, none for words met before."""

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.n = tokenizer, 0

        def encode_batch_fast(self, texts, **options):
            self.n += len(texts)
            return self.tokenizer.encode_batch_fast(texts, **options)

    encoder = _word_encoder()
    whole, draw = encoder.tokenizer, random.Random(7)
    words = ["".join(draw.choices("abcdefgéñüжд", k=draw.randint(2, 12))) for _ in range(1000)]
    texts = [" ".join(words[:500]), "", None, " ".join(words[500:]) + ". It's 42"]
    want = [[*whole.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    encoder.tokenizer = Counted(whole)
    assert _encoded(encoder, texts) == want and encoder.tokenizer.n <= 10
    encoder.tokenizer.n = 0
    assert _encoded(encoder, texts[::-1]) == want[::-1] and encoder.tokenizer.n == 0


def test_letters_that_split_and_words_that_are_forgotten(monkeypatch):
    """Letters that become a letter and a mark, groups of three words, ten words remembered."""
    for name, value in (("LETTER_WORDS", 10), ("GROUP_WORDS", 3), ("CHUNK_BYTES", 40)):
        monkeypatch.setattr(token_shards, name, value)
    encoder = _word_encoder()
    whole = encoder.tokenizer

    @settings(max_examples=100, deadline=None)
    @given(st.lists(st.lists(st.text("ab\u0130\u0131\u00df\u01c5\u0958\u212b\u1100\u1161\uac00", min_size=1, max_size=5), max_size=12), max_size=8))
    def same_ids(texts):
        texts = [" ".join(t) for t in texts]
        assert _encoded(encoder, texts) == [[*whole.encode(t, add_special_tokens=False).ids, 1] for t in texts]
        assert len(encoder.letters) == len(encoder.letter_ids) == len(encoder.met) <= 10 + 60

    same_ids()
    assert _encoded(encoder, ["\u0130zmir ankara"]) == [[*whole.encode("\u0130zmir ankara", add_special_tokens=False).ids, 1]]
    assert {"\u0130zmir", "ankara"} <= encoder.words.keys()  # their group went word by word
