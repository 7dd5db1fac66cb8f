"""Token ids in grammar-compressed shards with random access.

Documents are dealt by ranges of doc_id, and every task writes one file: the ids of its
documents in order, cut into shards of at most SHARD_IDS ids. Each shard is compressed by
Re-Pair (``grammar``): a frequent id pair becomes a nonterminal, again and again. A shard stores
its rules, how many ids each rule expands to, the remaining sequence and the id position of every
SAMPLE-th symbol of it, so any range of ids is decoded from the symbols that cover it. The index,
one row per document, says where its ids lie; a document longer than the rest of a shard goes on
in the next one. Files that no index row names are the rest of a lost attempt.

File format: shards one after the other. A shard is five unsigned 64-bit numbers (first
nonterminal, rules, symbols, ids, bytes a symbol), the rules as pairs of symbols, 32-bit expansion
lengths, the sequence, and 32-bit positions; all numbers little-endian.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewharf.llm import grammar
from tradewharf.llm.base import Scratch, file_system

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Ids in a shard, and the places a rule has to replace.
SHARD_IDS, LEAST = 1 << 19, 16
#: Every so many symbols the id position is stored.
SAMPLE = 256
#: Text bytes a writing task gets, and ids a reading task gets.
TASK_BYTES, TASK_IDS = 32_000_000, 16_000_000
#: Words of letters whose ids a worker remembers, others (twice over), and characters looked up at once.
LETTER_WORDS, KNOWN_WORDS, CHUNK_BYTES = 1_000_000, 150_000, 6_000_000
#: New words of letters that are encoded as one text.
GROUP_WORDS = 256

#: Between a letter and ASCII punctuation other than apostrophe and bar a space goes in.
CUT = (r"(\pL)([!-&(-/:-@\[-`{}~])", r"\1 \2")

#: Words that are one piece to the tokenizer, unless lower case or NFC splits a letter.
LETTERS = r"^\pL+$"

PIECES = "array<struct<at: long, length: long, first: long, n: long>>"
INDEX_SCHEMA = f"doc_id long, part int, start long, n_tokens long, file string, pieces {PIECES}"


class Encoder:
    """Ids of whole texts. The tokenizer takes lower case, and no token reaches across white space
    or from a letter into ASCII punctuation. So a text's ids are those of its words, cut there,
    and each word is encoded once while it is remembered. Apostrophes begin contractions and bars
    belong to the tokenizer's control strings: at these nothing is cut.

    Nearly all words are letters alone. Those are remembered in Arrow arrays, looked up together,
    and the new ones are encoded many to a text: a token with the end-of-word suffix is a word's
    last. The others are remembered and encoded one by one."""

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.letters, self.letter_ids = pa.array([], pa.string()), pa.array([], pa.list_(pa.uint32()))
        #: The chunk in which each word of letters was last met, and the number of this one.
        self.met, self.chunk = np.empty(0, np.int64), 0
        suffix, tokens = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab()
        self.last = np.zeros(max(tokens.values(), default=0) + 1, bool)
        self.last[[i for token, i in tokens.items() if suffix and token.endswith(suffix)]] = True

    def _ids(self, words: list[str]) -> list[bytes]:
        if len(self.words) > KNOWN_WORDS:
            self.words, self.older = {}, self.words
        known, older = self.words, self.older
        found = list(map(known.get, words))
        new = []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            found[i] = older.get(words[i])
            if found[i] is None:
                new.append(i)
            else:
                known[words[i]] = found[i]
        asked = [words[i] for i in new]
        for i, e in zip(new, self.tokenizer.encode_batch_fast(asked, add_special_tokens=False)):
            known[words[i]] = found[i] = array("I", e.ids).tobytes()
        return found

    def _joined(self, words: list[str]) -> pa.ListArray:
        """Ids of words of letters. Each is one piece or more, so a group with as many last tokens
        as words has one a word; another group is encoded word by word."""
        groups = [words[i : i + GROUP_WORDS] for i in range(0, len(words), GROUP_WORDS)]
        flat, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(group) or ends[-1] != len(ids):
                parts = self._ids(group)
                ids, ends = np.frombuffer(b"".join(parts), "<u4"), np.cumsum([len(p) // 4 for p in parts])
            flat.append(ids)
            sizes.append(np.diff(ends, prepend=0))
        return _lists(np.concatenate(flat), np.concatenate(sizes))

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where the ids of these distinct words of letters are in ``letter_ids``."""
        self.chunk += 1
        if len(self.letters) > LETTER_WORDS:
            keep = np.argsort(-self.met, kind="stable")[: LETTER_WORDS // 2]
            self.letters, self.letter_ids, self.met = self.letters.take(keep), self.letter_ids.take(keep), self.met[keep]
        place = pc.index_in(words, value_set=self.letters)
        new = words.filter(pc.is_null(place))
        place = pc.fill_null(place, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[place < 0] = len(self.letters) + np.arange(len(new))
        self.letters = pa.concat_arrays([self.letters, new])
        self.letter_ids = pa.concat_arrays([self.letter_ids, self._joined(new.to_pylist())])
        self.met = np.append(self.met, np.empty(len(new), np.int64))
        self.met[place] = self.chunk
        return place

    def encode(self, texts: pa.Array, end_id: int) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids with the end id) of every text; null is empty."""
        texts = pc.fill_null(texts, "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        row = 0
        while row < len(texts):
            past = int(np.searchsorted(ends, (ends[row - 1] if row else 0) + CHUNK_BYTES, "right"))
            past = max(past, row + 1)
            yield from zip(range(row, past), self._chunk(texts.slice(row, past - row), end_id))
            pa.default_memory_pool().release_unused()  # else each chunk's peak stays with the worker
            row = past

    def _chunk(self, texts: pa.Array, end_id: int) -> Iterator[np.ndarray]:
        lower = pc.replace_substring(pc.ascii_lower(texts), "\n", " ")
        split = pc.split_pattern(pc.replace_substring_regex(lower, *CUT), " ")
        seen = split.flatten().dictionary_encode()
        words = seen.dictionary
        plain = pc.match_substring_regex(words, LETTERS)
        plain_at, other_at = (np.flatnonzero(m.to_numpy(zero_copy_only=False)) for m in (plain, pc.invert(plain)))
        place = np.empty(len(words), np.int64)
        place[plain_at] = self._places(words.take(plain_at))
        place[other_at] = len(self.letters) + np.arange(len(other_at))
        others = [*self._ids(words.take(other_at).to_pylist()), array("I", [end_id]).tobytes()]
        others = _lists(np.frombuffer(b"".join(others), "<u4"), np.fromiter(map(len, others), np.int64, len(others)) // 4)
        lists = pa.concat_arrays([self.letter_ids, others])
        offsets = split.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = offsets - offsets[0]
        # The end id is one more word after each text.
        word = np.insert(place[seen.indices.to_numpy(zero_copy_only=False)], offsets[1:], len(lists) - 1)
        found = lists.take(word)
        whole, at = found.values.to_numpy(), found.offsets.to_numpy()
        before = at[0]
        for end in at[offsets[1:] + np.arange(1, len(offsets))].tolist():
            yield whole[before:end]
            before = end


def _lists(flat: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """Lists of these sizes, one after the other."""
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), flat.astype(np.uint32))


_ENCODERS: dict[int, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """The worker's encoder of this vocabulary; its remembered words outlive a task."""
    key = hash(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary)
    return _ENCODERS[key]


def _packed(symbols: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(symbols.astype("<u8").reshape(-1, 1).view(np.uint8)[:, :width]).tobytes()


def _unpacked(data: memoryview, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel().astype(np.int64)


def pack_shard(ids: np.ndarray, first: int, least: int = LEAST) -> bytes:
    """The bytes of a shard with these ids, all below ``first``."""
    g = grammar.compress(ids, first, least)
    width = max(1, (int(first + len(g.rules) - 1).bit_length() + 7) // 8)
    ends = np.cumsum(g.widths(g.sequence))
    before = np.concatenate([[0], ends])[: len(g.sequence) : SAMPLE] if len(g.sequence) else np.empty(0, np.int64)
    head = np.array([first, len(g.rules), len(g.sequence), len(ids), width], "<u8")
    return b"".join([
        head.tobytes(), _packed(g.rules.ravel(), width), g.lengths.astype("<u4").tobytes(),
        _packed(g.sequence, width), before.astype("<u4").tobytes(),
    ])


class Shard:
    """A packed shard, of which ``ids`` decodes any range."""

    def __init__(self, data: bytes) -> None:
        first, n_rules, n_symbols, self.n, self.width = map(int, np.frombuffer(data, "<u8", 5))
        view, at = memoryview(data), 40
        rules = _unpacked(view[at : at + 2 * n_rules * self.width], self.width).reshape(-1, 2)
        at += 2 * n_rules * self.width
        lengths = np.frombuffer(data, "<u4", n_rules, at).astype(np.int64)
        at += 4 * n_rules
        self.symbols = view[at : at + n_symbols * self.width]
        self.before = np.frombuffer(data, "<u4", -1, at + n_symbols * self.width).astype(np.int64)
        self.grammar = grammar.Grammar(np.empty(0, np.int64), rules, first, lengths)

    def ids(self, first: int, n: int) -> np.ndarray:
        """Ids ``first`` to ``first + n`` from the stored positions around them."""
        lo = max(int(np.searchsorted(self.before, first, "right")) - 1, 0)
        hi = int(np.searchsorted(self.before, first + n, "left"))
        symbols = _unpacked(self.symbols[lo * SAMPLE * self.width : hi * SAMPLE * self.width], self.width)
        ends = np.cumsum(self.grammar.widths(symbols)) + self.before[lo]
        a, b = int(np.searchsorted(ends, first, "right")), int(np.searchsorted(ends, first + n, "left")) + 1
        begin = int(ends[a - 1]) if a else int(self.before[lo])
        return self.grammar.expand(symbols[a:b])[first - begin : first - begin + n]


class _Writer:
    """One task's file. Documents are appended; a full shard is packed and written at once."""

    def __init__(self, folder: str, first: int, shard_ids: int, least: int) -> None:
        self.folder, self.first, self.shard_ids, self.least = folder, first, shard_ids, least
        self.name, self.out, self.at = f"{uuid.uuid4().hex}.ids", None, 0
        self.held: list[np.ndarray] = []
        self.n = self.start = 0
        self.rows: list[dict] = []

    def add(self, doc_id: int | None, part: int, ids: np.ndarray) -> Iterator[list[dict]]:
        """Index rows that became final."""
        row = {"doc_id": doc_id, "part": part, "start": self.start, "n_tokens": len(ids), "file": self.name, "pieces": []}
        self.rows.append(row)
        self.start += len(ids)
        while len(ids):
            take = ids[: self.shard_ids - self.n]
            row["pieces"].append({"at": self.at, "length": None, "first": self.n, "n": len(take)})
            self.held.append(take)
            self.n += len(take)
            ids = ids[len(take) :]
            if self.n == self.shard_ids:
                done = self._flush(keep=row if len(ids) else None)
                if done:
                    yield done

    def _flush(self, keep: dict | None = None) -> list[dict]:
        if not self.n:
            return []
        if self.out is None:
            fs, root = file_system(self.folder)
            fs.create_dir(root)
            self.out = fs.open_output_stream(f"{root}/{self.name}", compression=None)
        data = pack_shard(np.concatenate(self.held), self.first, self.least)
        self.out.write(data)
        for row in self.rows:
            row["pieces"][-1]["length"] = len(data)
        done = [r for r in self.rows if r is not keep]
        self.rows = [keep] if keep else []
        self.at += len(data)
        self.held, self.n = [], 0
        return done

    def close(self) -> list[dict]:
        done = self._flush()
        if self.out is not None:
            self.out.close()
        return done


def _index_batch(rows: list[dict]) -> pa.RecordBatch:
    piece = pa.list_(pa.struct([(k, pa.int64()) for k in ("at", "length", "first", "n")]))
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), piece]
    names = ("doc_id", "part", "start", "n_tokens", "file", "pieces")
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(names, kinds)], names=list(names))


def _writing(folder: str, vocabulary: str, end_id: int, shard_ids: int, least: int) -> Callable:
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        out = _Writer(folder, max(encode.tokenizer.get_vocab_size(), end_id + 1), shard_ids, least)
        for batch in batches:
            ids, parts = batch.column("doc_id").to_pylist(), batch.column("part").to_pylist()
            for row, tokens in encode.encode(batch.column("text"), end_id):
                for done in out.add(ids[row], parts[row], tokens):
                    yield _index_batch(done)
        done = out.close()
        if done:
            yield _index_batch(done)

    return write


def write_shards(
    docs: DataFrame, folder: str, vocabulary_path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS, least: int = LEAST
) -> DataFrame:
    """Writes the shards of all ``docs`` (doc_id, text) when the returned index is written.

    ``start`` counts ids inside a part; parts are in the order of doc_id, nulls first, equal ids in
    the order of a hash of the text. A null or empty text is its end id alone. Other columns are
    left out. The vocabulary (a few MB) is read by the driver and sent along with the function.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = f.read()
    spark = docs.sparkSession
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = rows.repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    return dealt.withColumn("part", F.spark_partition_id()).mapInArrow(
        _writing(folder, vocabulary, end_id, shard_ids, least), INDEX_SCHEMA
    )


def placed(index: DataFrame) -> DataFrame:
    """The index with ``start`` counted from the first id of all parts. Running sums go over parts,
    in blocks of a thousand of them."""
    sums = index.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("block", F.expr("part div 1000"))
    blocks = sums.groupBy("block").agg(F.sum("n").alias("n"))
    blocks = blocks.select("block", (F.sum("n").over(Window.orderBy("block")) - F.col("n")).alias("_tw_block"))
    inside = Window.partitionBy("block").orderBy("part")
    before = sums.withColumn("_tw_part", F.sum("n").over(inside) - F.col("n")).join(blocks, "block")
    before = before.select("part", (F.col("_tw_part") + F.col("_tw_block")).alias("_tw_before"))
    return index.join(before, "part").withColumn("start", F.col("start") + F.col("_tw_before")).drop("_tw_before")


def _reading(folder: str) -> Callable:
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        opened, handle = None, None
        shards: dict[int, Shard] = {}

        def shard(file: str, at: int, length: int) -> Shard:
            nonlocal opened, handle
            if opened != file:
                if handle:
                    handle.close()
                opened, handle = file, fs.open_input_file(f"{root}/{file}")
                shards.clear()
            if at not in shards:
                if len(shards) > 1:
                    shards.pop(min(shards))
                shards[at] = Shard(handle.read_at(length, at))
            return shards[at]

        def out(rows: list, ids: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "start", "ids"],
            )

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "start", "file", "pieces")]
            rows, at = list(zip(*cols)), 0
            while at < len(rows):
                # Neighbours that end in the shard where they begin are decoded in one go.
                file, first = rows[at][2], rows[at][3][0]
                past = at
                while past < len(rows) and rows[past][2] == file and len(rows[past][3]) == 1 and rows[past][3][0]["at"] == first["at"]:
                    past += 1
                if past == at:
                    ids = [shard(file, p["at"], p["length"]).ids(p["first"], p["n"]).astype("<u4").tobytes() for p in rows[at][3]]
                    yield out(rows[at : at + 1], [b"".join(ids)])
                    at += 1
                    continue
                spans = [(r[3][0]["first"], r[3][0]["n"]) for r in rows[at:past]]
                lo, hi = min(f for f, _ in spans), max(f + n for f, n in spans)
                got = shard(file, first["at"], first["length"]).ids(lo, hi - lo).astype("<u4").tobytes()
                yield out(rows[at:past], [got[4 * (f - lo) : 4 * (f - lo + n)] for f, n in spans])
                at = past
        if handle:
            handle.close()

    return read


def read_ids(folder: str, index: DataFrame) -> DataFrame:
    """doc_id, start, ids (little-endian unsigned 32-bit) of the index rows given, from the files.
    Any rows of the index will do; only the shards they name are read. Read in the order of place,
    a task takes about TASK_IDS ids."""
    total = index.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_IDS))
    at = F.expr("pieces[0].at")
    rows = index.select("doc_id", "start", "file", "pieces")
    dealt = rows.repartition(tasks, "file", at).sortWithinPartitions("file", at, F.expr("pieces[0].first"))
    return dealt.mapInArrow(_reading(folder), "doc_id long, start long, ids binary")


def report(docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """One row per document, from the ids read back."""
    scratch = Scratch(docs.sparkSession, "token-shards")
    folder = scratch.folder("files")
    index = scratch.cut(write_shards(docs, folder, vocabulary_path or public_tokenizers.path(VOCABULARY)), "index")
    ids = read_ids(folder, placed(index))
    return ids.select("doc_id", "start", F.expr("octet_length(ids) div 4L").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
