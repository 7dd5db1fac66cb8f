"""Surrogates for personal data.

Entities are found by patterns, named by a canonical form, and get keyed surrogates of the same
type: digits for digits, letters of the same case and script, valid check digits, given names of
the gender the title tells. All mentions that a pattern finds get their entity's surrogate; two
entities of a type never share one, and none is a real entity of the corpus: collisions are found
by aggregates over the entity table and drawn again until none is left.

A name is found directly after one of the titles below only. The bare "Smith" that follows "Mr.
John Smith", and names after other titles (Dr, Prof) or none, stay in clear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewharf.llm.base import Scratch, row_key
from tradewharf.operators.relational import union_frames

#: A demonstration key. Real use passes a secret.
KEY = "surrogate-key-1"

#: Draws in which a surrogate may not be another entity's real value.
REAL_TRIES = 8

_MALE = "Mr|Herr|Monsieur|Señor|Sr|Signor|г-н|κ"
_FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Signora|г-жа|κα"
_NEUTRAL = "Dr|Prof|Doctor|Professor"
_GIVEN = r"\p{Lu}\p{L}*(?:['’-]\p{L}+)*"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Type -> pattern, in the order of precedence.
PATTERNS = {
    "email": r"[A-Za-z0-9_%+-][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "password": r"(?i:\b(?:password|passwd|pwd)\s{0,2}[=:]\s{0,2}[\"']?)[^\s\"']{6,}",
    "token": r"(?i:\b(?:token|secret|api_?key|access_?key)\s{0,2}[=:]\s{0,2}[\"']?)[A-Za-z0-9_+/-]{16,}",
    "cloud_key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}[ -]?){3}[0-9]{1,7}(?![0-9])",
    "phone": r"\+[0-9]{8,15}(?![0-9])|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,4}(?![0-9])|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|(?<![0-9-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_MALE}|{_FEMALE}|{_NEUTRAL})\.?[ ]{_GIVEN}\p{{Ll}}(?:[ ]{_GIVEN}\p{{Ll}})?(?!\p{{L}})",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A cheap test that every entity passes.
HINT = rf"[0-9@]|AKIA|ASIA|(?i:pass|pwd|token|secret|key)\w{{0,5}}\s{{0,2}}[=:]|(?:{_MALE}|{_FEMALE}|{_NEUTRAL})\.?[ ]\p{{Lu}}"

#: Syllables of surrogate names by script, and endings by gender.
SYLLABLES = {
    "latin": ["ba", "de", "fi", "go", "lu", "ma", "ne", "ri", "so", "tu", "va", "ke", "li", "mo", "nu", "ra"],
    "cyrillic": ["ба", "де", "фи", "го", "лу", "ма", "не", "ри", "со", "ту", "ва", "ке", "ли", "мо", "ну", "ра"],
    "greek": ["βα", "δε", "φι", "γο", "λυ", "μα", "νε", "ρι", "σο", "τυ", "πα", "κε", "λι", "μο", "νυ", "ρα"],
}
ENDINGS = {
    "latin": {"m": "n", "f": "na", "": "sen", "n": "l"},
    "cyrillic": {"m": "н", "f": "на", "": "нко", "n": "ль"},
    "greek": {"m": "ς", "f": "να", "": "κης", "n": "λ"},
}


def _quoted(text: str) -> str:
    return "r'" + text.replace("'", "\\x27") + "'"


def _kind(surface: str) -> str:
    """SQL: the type of a match, the first pattern it fits as a whole."""
    cases = " ".join(f"when {surface} rlike {_quoted(f'^(?:{p})$')} then '{t}'" for t, p in PATTERNS.items())
    return f"case {cases} end"


def luhn(digits: str, odd: int = 0) -> str:
    """SQL: Luhn sum modulo 10 of a digit string; ``odd`` shifts which places are doubled."""
    return (
        f"aggregate(transform(split(reverse({digits}), ''), (d, i) -> if((i + {odd}) % 2 = 0, try_cast(d as bigint), "
        "try_cast(d as bigint) * 2 div 10 + try_cast(d as bigint) * 2 % 10)), 0L, (s, x) -> s + x) % 10"
    )


def with_matches(docs: DataFrame) -> DataFrame:
    """``docs`` that may hold entities plus ``_tw_m``, the matched strings in order."""
    some = docs.where(F.col("text").rlike(HINT))
    return some.withColumn("_tw_m", F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).where("size(_tw_m) > 0")


def mentions(rows: DataFrame) -> DataFrame:
    """One row per part of a match: doc_id, _tw_key, at, part, piece, type, canon.

    A name with a given name has two parts; all other matches have one. ``piece`` is the part's
    text with what stands before it; a match that fails its check (a card number with a wrong
    check digit) has no type and is left as it is."""
    each = rows.select("doc_id", "_tw_key", F.posexplode("_tw_m").alias("at", "s")).withColumn("t", F.expr(_kind("s")))
    each = each.withColumn("digits", F.regexp_replace("s", "[^0-9]", ""))
    each = each.withColumn("t", F.expr(f"if(t = 'card' and (length(digits) not between 13 and 19 or {luhn('digits')} <> 0), null, t)"))
    each = each.withColumns({
        "gender": F.expr(f"case when t <> 'name' then '' when s rlike {_quoted(f'^(?:{_FEMALE})[. ]')} then 'f' when s rlike {_quoted(f'^(?:{_NEUTRAL})[. ]')} then 'n' else 'm' end"),
        "words": F.expr("if(t = 'name', split(s, ' '), null)"),
        "value": F.expr(
            "case when t in ('password', 'token') then regexp_extract(s, r'[=:]\\s{0,2}[\"\\x27]?(.*)$', 1) "
            "when t in ('card', 'phone', 'national_id') then digits when t = 'email' then lower(s) when t = 'iban' then replace(s, ' ', '') else s end"),
    })
    parts = F.expr(
        "case when size(words) = 3 then array("
        "named_struct('piece', concat(words[0], ' ', words[1]), 'type', concat('given_', gender), 'canon', lower(words[1])), "
        "named_struct('piece', concat(' ', words[2]), 'type', 'family', 'canon', lower(words[2]))) "
        "when size(words) = 2 then array(named_struct('piece', s, 'type', 'family', 'canon', lower(words[1]))) "
        "else array(named_struct('piece', s, 'type', t, 'canon', value)) end"
    )
    return each.select("doc_id", "_tw_key", "at", F.posexplode(parts).alias("part", "p")).select("doc_id", "_tw_key", "at", "part", "p.*")


def _stream(key: str) -> str:
    """SQL: keyed hex digits for a type, canonical form and attempt, as many as needed."""
    seed = f"{_quoted(key)}, '/', type, '/', attempt, '/', canon, '/'"
    return f"array_join(transform(sequence(0, length(canon) div 30 + 1), b -> sha2(concat({seed}, b), 256)), '')"


_NUMBER = "cast(conv(substr(stream, {at}, 4), 16, 10) as int)"


def _same_class(text: str) -> str:
    """SQL: every digit and letter replaced by a keyed one of its case and script."""
    def draw(first: str, n: int) -> str:
        return f"char(ascii('{first}') + {_NUMBER.format(at='2 * i + 1')} % {n})"

    def wide(first: str, n: int) -> str:
        letters = "".join(chr(ord(first) + k) for k in range(n))
        return f"substr('{letters}', 1 + {_NUMBER.format(at='2 * i + 1')} % {n}, 1)"

    hexa = "canon rlike '^[0-9a-f]+$'"
    return (
        f"array_join(transform(split({text}, ''), (c, i) -> case when c rlike '[0-9]' then {draw('0', 10)} "
        f"when c rlike '[a-z]' then if({hexa}, {draw('a', 6)}, {draw('a', 26)}) when c rlike '[A-Z]' then {draw('A', 26)} "
        f"when c rlike r'\\p{{IsCyrillic}}' then if(c = lower(c), {wide('а', 32)}, {wide('А', 32)}) "
        f"when c rlike r'\\p{{IsGreek}}' then if(c = lower(c), {wide('α', 17)}, {wide('Α', 17)}) else c end), '')"
    )


def _name(gender: str) -> str:
    """SQL: three syllables and the gender's ending; two more syllables with each further draw."""
    def of(script: str) -> str:
        pool = ", ".join(f"'{s}'" for s in SYLLABLES[script])
        draws = f"array_join(transform(sequence(0, 2 + 2 * least(attempt, 6)), k -> array({pool})[{_NUMBER.format(at='1 + 4 * k')} % 16]), '')"
        return f"concat({draws}, '{ENDINGS[script][gender]}')"

    return f"case when canon rlike r'\\p{{IsCyrillic}}' then {of('cyrillic')} when canon rlike r'\\p{{IsGreek}}' then {of('greek')} else {of('latin')} end"


def mod97(text: str) -> str:
    """SQL: ISO 7064 remainder of a string of digits and capitals; A is 10, Z is 35."""
    value = "if(c rlike '[0-9]', (s * 10 + cast(c as int)) % 97, (s * 100 + ascii(c) - 55) % 97)"
    return f"aggregate(split({text}, ''), 0, (s, c) -> if(c = '', s, {value}))"


def _draw() -> str:
    """SQL: the surrogate of (type, canon, stream); it has the canonical form of its type."""
    same = _same_class("canon")
    octets = ", ".join(f"({1 if k in (0, 3) else 0} + {_NUMBER.format(at=1 + 4 * k)} % {223 if k == 0 else 254})" for k in range(4))
    card = f"concat(substr(canon, 1, 1), substr({same}, 2, length(canon) - 2))"
    number = f"concat(substr(canon, 1, 1), {1} + {_NUMBER.format(at=61)} % 9, substr({same}, 3))"
    account = f"substr({same}, 5)"
    iban = (
        f"transform(array({account}), a -> concat(substr(canon, 1, 2), lpad(cast(98 - {mod97(f"concat(a, substr(canon, 1, 2), '00')")} as string), 2, '0'), a))[0]"
    )
    return (
        f"case type when 'ip' then concat_ws('.', {octets}) "
        f"when 'card' then concat({card}, (10 - {luhn(card, 1)}) % 10) "
        f"when 'phone' then {number} when 'cloud_key' then concat(substr(canon, 1, 4), substr({same}, 5)) "
        f"when 'iban' then {iban} "
        f"when 'email' then concat(substr('xyzw', 1, attempt div 4), substr({same}, 1, length(canon) - length(regexp_extract(canon, r'[^.]*$', 0))), regexp_extract(canon, r'[^.]*$', 0)) "
        f"when 'given_m' then {_name('m')} when 'given_n' then {_name('n')} when 'given_f' then {_name('f')} when 'family' then {_name('')} else {same} end"
    )


def surrogates(entities: DataFrame, scratch: Scratch, key: str = KEY) -> DataFrame:
    """type, canon, surrogate for distinct (type, canon).

    Each round draws for the entities that are still open. Who draws what is settled, or what
    another open entity with a smaller canon drew, or a real entity, draws again. The settled ones
    are not touched again, so later rounds are small. All checks are joins and aggregates."""
    open_ = scratch.cut(entities.withColumn("attempt", F.lit(0)), "open0")
    settled, step = [], 0
    real = entities.select(F.col("type").alias("_t"), F.col("canon").alias("_s"))
    while not open_.isEmpty():
        drawn = open_.withColumn("stream", F.expr(_stream(key))).withColumn("surrogate", F.expr(_draw())).drop("stream")
        drawn = scratch.cut(drawn, f"drawn{step}")
        same = (F.col("type") == F.col("_t")) & (F.col("surrogate") == F.col("_s"))
        owner = drawn.groupBy(F.col("type").alias("_t"), F.col("surrogate").alias("_s")).agg(F.min("canon").alias("_first"))
        free = drawn.join(owner, same).where("canon = _first").drop("_t", "_s", "_first")
        for table in settled:
            taken = table.select(F.col("type").alias("_t"), F.col("surrogate").alias("_s"))
            free = free.join(taken, same, "left_anti")
        if step < REAL_TRIES:
            free = free.join(real, same, "left_anti")
        kept = scratch.cut(free.select("type", "canon", "surrogate"), f"settled{step}")
        settled.append(kept)
        left = drawn.join(kept.select(F.col("type").alias("_t"), F.col("canon").alias("_c")), (F.col("type") == F.col("_t")) & (F.col("canon") == F.col("_c")), "left_anti")
        open_ = scratch.cut(left.select("type", "canon", (F.col("attempt") + 1).alias("attempt")), f"open{step + 1}")
        scratch.drop(f"drawn{step}", f"open{step}")
        step += 1
        if len(settled) > 8:
            settled = [scratch.cut(union_frames(settled), f"all{step}")]
    return union_frames(settled) if settled else entities.withColumn("surrogate", F.col("canon"))


def _rendered() -> Column:
    """A piece with its value replaced; digits go where the digits of the piece were."""
    return F.expr(
        "case when surrogate is null then piece "
        "when type in ('card', 'phone', 'national_id') or type = 'iban' then "
        "aggregate(split(piece, ''), named_struct('o', '', 'k', 1), (a, c) -> if(c rlike '[0-9A-Za-z]', "
        "named_struct('o', concat(a.o, substr(surrogate, a.k, 1)), 'k', a.k + 1), named_struct('o', concat(a.o, c), 'k', a.k)), a -> a.o) "
        "when type = 'email' then if(piece = upper(piece), upper(surrogate), surrogate) "
        "when type in ('password', 'token') then concat(substr(piece, 1, length(piece) - length(canon)), surrogate) "
        "when type = 'family' or type like 'given%' then concat(substr(piece, 1, length(piece) - length(canon)), initcap(surrogate)) "
        "else surrogate end"
    )


def anonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced, plus ``n_entities``.

    Texts without entities, null ones too, stay as they are and are never shuffled. Equal rows
    come out equal. No rows give no rows.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    keyed = docs.withColumn("_tw_key", row_key(F.col("text")))
    found = scratch.cut(with_matches(keyed.select("doc_id", "_tw_key", "text")).select("doc_id", "_tw_key", "_tw_m").distinct(), "matches")
    parts = scratch.cut(mentions(found), "mentions")
    table = surrogates(parts.where("type is not null").select("type", "canon").distinct(), scratch, key)
    done = parts.join(table, ["type", "canon"], "left").withColumn("out", _rendered())
    lists = done.groupBy("doc_id", "_tw_key").agg(
        F.array_sort(F.collect_list(F.struct("at", "part", "out"))).alias("_tw_outs"),
        F.count_distinct(F.when(F.col("type").isNotNull(), F.col("at"))).alias("_tw_n"),
    )
    lists = scratch.cut(lists.withColumnsRenamed({"doc_id": "_tw_id", "_tw_key": "_tw_of"}), "replacements")
    # A text is its pieces between matches, each followed by the parts that replace the match.
    stitched = F.expr(
        "array_join(transform(split(text, _tw_any, -1), (p, i) -> concat(p, "
        "array_join(transform(slice(_tw_outs, 1 + coalesce(get(_tw_from, i), 0), coalesce(get(_tw_from, i + 1), size(_tw_outs)) - coalesce(get(_tw_from, i), size(_tw_outs))), o -> o.out), ''))), '')"
    )
    # Where the parts of match i begin among all parts.
    begins = F.expr("transform(filter(transform(_tw_outs, (o, i) -> struct(o.part, i)), o -> o.part = 0), o -> o.i)")
    has = F.coalesce(F.col("text").rlike(HINT) & F.col("text").rlike(ANY), F.lit(False))
    marked = keyed.withColumn("_tw_has", has)
    some = marked.where("_tw_has")
    joined = some.join(lists, some.doc_id.eqNullSafe(lists._tw_id) & (some._tw_key == lists._tw_of))
    changed = joined.withColumns({"_tw_from": begins, "_tw_any": F.lit(ANY)}).withColumns({"text": stitched, "n_entities": F.col("_tw_n")})
    columns = [*[c for c in docs.columns if c != "n_entities"], "n_entities"]
    plain = marked.where("not _tw_has").withColumn("n_entities", F.lit(0).cast("long"))
    return changed.select(*columns).unionByName(plain.select(*columns))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: its text with surrogates and how many entities were replaced."""
    return anonymise(docs.select("doc_id", "text"))
