"""PII surrogates (operator 7).

Detected entities are replaced by invented ones of the same type and format.
A surrogate is derived from a secret key and the entity's canonical value, so
every mention of an entity, in whatever layout and document, gets the same one
(coreference), written in that mention's own layout. Names keep their script
and the gender that their title tells; given and family names are entities of
their own, so "Frau Anna Berg" and "Frau Berg" still belong together. A full
name that a title stands before anywhere in a text is an entity without title
in that text too, and of the gender that any of its titles tells. Phone numbers
with a country code other than 1 are told apart by it.

Distinctness is checked, not hoped for: the corpus' distinct entities draw
surrogates in rounds, a surrogate that two entities drew, that was given
before, or that is itself an entity of the corpus goes to nobody but the
smallest drawer (to no one in the last case), and the losers draw again. Where
a format has no free values left, later rounds draw longer ones.
Entities are counted down by a partial aggregation before any of this, so a
hot entity is one row; the mentions get their surrogates by one equi-join.

Defined results: documents without entities are returned unchanged by
``replace_entities``; a null text stays null; repeated rows are treated
alike; a null id is passed through; an empty table gives no rows; other
columns are kept.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerflow.llm.common import keyed_rows, shared_table, unpacked

_MALE = "Mr|Mister|Sir|Herr|Monsieur|Señor|Sr|Signor|Господин|Κύριος"
_FEMALE = "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mademoiselle|Señora|Sra|Señorita|Signora|Госпожа|Κυρία"
_OTHER = "Dr|Prof|Professor|Mx|Доктор"
_NAME = r"[^\W\d_a-zа-яßà-öø-ÿα-ωά-ώ][^\W\d_]*(?:[-'’][^\W\d_]+)*"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: type -> pattern; the group "x" is the entity. Earlier types win overlaps.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])(?P<x>[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24})(?![A-Za-z0-9])",
    "access_key": r"(?<![A-Za-z0-9])(?P<x>(?:AKIA|ASIA)[A-Z0-9]{16})(?![A-Za-z0-9])",
    "secret": r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key))\s{0,3}[=:]\s{0,3}[\"']?(?P<x>[A-Za-z0-9_+/-]{8,200})",
    "iban": r"(?<![A-Za-z0-9])(?P<x>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "card": r"(?<![\w.+-])(?P<x>\d(?:[ -]?\d){12,18})(?![\w-])",
    "ssn": r"(?<![\w-])(?P<x>\d{3}-\d{2}-\d{4})(?![\w-])",
    "ip": rf"(?<![\w.])(?P<x>(?:{_OCTET}\.){{3}}{_OCTET})(?!\w|\.\d)",
    "phone": r"(?<![\w+])(?P<x>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)",
    "person": rf"\b(?:(?P<m>{_MALE})|(?P<f>{_FEMALE})|(?:{_OTHER}))\b\.?[ ](?P<x>{_NAME}(?:[ ]{_NAME}){{0,2}})",
}
#: What a text must hold for a pattern to be worth a look.
_HINT = {"email": "@", "access_key": "IA", "ip": ".", "ssn": "-"}
#: Rounds of draws in an entity's own format; later ones are longer.
ROUNDS = 40


def luhn(digits: str) -> bool:
    total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def _iban(value: str) -> bool:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _country_code(phone: str) -> str:
    code = re.match(r"\+(\d{1,3})(?=\D)", phone)
    return code.group(1) if code else ""


def script_of(name: str) -> str:
    kind = unicodedata.name(name[0], "LATIN").split(" ")[0]
    return kind if kind in _SYLLABLES else "LATIN" if kind == "LATIN" else "OTHER"


@lru_cache(maxsize=1)
def _compiled() -> dict[str, re.Pattern]:
    return {k: re.compile(p) for k, p in PATTERNS.items()}


def mentions_of(text: str) -> list[tuple[int, int, str, str, str]]:
    """(start, stop, type, entity, raw) of a text's mentions, without overlap;
    ``entity`` is the canonical value that all layouts of it share."""
    found: list[tuple[int, int, str, str, str]] = []
    taken: list[tuple[int, int]] = []
    people: list[tuple[int, str, str]] = []
    digits = any(c in text for c in "0123456789")
    for kind, pattern in _compiled().items():
        if (h := _HINT.get(kind)) and h not in text or not digits and kind in ("iban", "card", "ssn", "ip", "phone"):
            continue
        for m in pattern.finditer(text):
            a, b = m.span("x")
            if any(a < d and c < b for c, d in taken):
                continue
            raw = m.group("x")
            plain = re.sub(r"\D", "", raw)
            if kind == "card" and not (luhn(plain) or len(plain) == 16 and plain[0] in "3456"):
                continue
            if kind == "iban" and not _iban(raw.replace(" ", "")):
                continue
            taken.append((a, b))
            if kind == "person":
                people.append((a, raw, "m" if m.group("m") else "f" if m.group("f") else "u"))
                continue
            entity = raw
            if kind == "email":
                entity = raw.lower()
            elif kind == "phone":  # with or without the country code 1
                code = _country_code(raw)
                entity = plain[len(code) :] if code in ("", "1") else f"+{code} {plain[len(code) :]}"
            elif kind in ("card", "ssn"):
                entity = plain
            elif kind == "iban":
                entity = raw.replace(" ", "")
            found.append((a, b, kind, entity, raw))
    return sorted(found + _named(text, people, taken))


def _named(text: str, people: list[tuple[int, str, str]], taken: list[tuple[int, int]]) -> list[tuple[int, int, str, str, str]]:
    """The parts of the titled names (start, name, gender), and of the same full
    names where they stand without a title."""
    gender = {raw.casefold(): g for _, raw, g in sorted(people, key=lambda p: p[2] == "u", reverse=True)}
    full = sorted({raw for _, raw, _ in people if " " in raw}, key=len, reverse=True)
    if full:
        for m in re.finditer(rf"(?<!\w)(?:{'|'.join(map(re.escape, full))})(?!\w)", text):
            if not any(m.start() < d and c < m.end() for c, d in taken):
                people.append((m.start(), m.group(), "u"))
    parts = []
    for a, raw, _ in people:
        known = gender[raw.casefold()]
        words = list(re.finditer(r"\S+", raw))
        for k, w in enumerate(words):
            part = "family" if k == len(words) - 1 else f"given_{known}"
            tail = "_f" if part == "family" and known == "f" and script_of(w.group()) == "CYRILLIC" else ""
            parts.append((a + w.start(), a + w.end(), part + tail, w.group().casefold(), w.group()))
    return parts


#: Syllables of invented names, by script; and endings by gender.
_SYLLABLES = {
    "LATIN": "ba be bo da de do fa fe ga go ha he ja jo ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve vo".split(),
    "CYRILLIC": "ба бе бо да де до га го жа за ка ке ко ла ле ло ма ме мо на не но па пе ра ре ро са се со та те то ва ве во".split(),
    "GREEK": "βα βε βο δα δε δο γα γο κα κε κο λα λε λο μα με μο να νε νο πα πε ρα ρε ρο σα σε σο τα τε το".split(),
}
_ENDINGS = {
    ("LATIN", "given_m"): "n r l s".split(), ("LATIN", "given_f"): "lia na ra tta".split(), ("LATIN", "family"): "nd rt lsen mer".split(),
    ("CYRILLIC", "given_m"): "н р л с".split(), ("CYRILLIC", "given_f"): "лия на ра та".split(), ("CYRILLIC", "family"): "нов ров лин мин".split(), ("CYRILLIC", "family_f"): "нова рова лина мина".split(),
    ("GREEK", "given_m"): "νος ρης λος".split(), ("GREEK", "given_f"): "νια ρα λη".split(), ("GREEK", "family"): "δης κος λας".split(),
}


class _Draw:
    """Numbers from the key, the entity and the attempt."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int) -> None:
        seed = hashlib.blake2b(f"{kind}\0{attempt}\0{entity}".encode(), key=key[:64]).digest()
        self._bytes = hashlib.shake_256(seed).digest(4 * len(entity) + 64)
        self._at = 0

    def below(self, n: int) -> int:
        self._at += 2
        return int.from_bytes(self._bytes[self._at - 2 : self._at], "little") % n

    def char(self, c: str, hexadecimal: bool = False) -> str:
        if hexadecimal:
            return "0123456789abcdef"[self.below(16)] if not c.isupper() else "0123456789ABCDEF"[self.below(16)]
        if c.isdigit():
            return str(self.below(10))
        if c.isascii() and c.isalpha():
            return chr((65 if c.isupper() else 97) + self.below(26))
        return c


def draw(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """The canonical surrogate of an entity at this attempt; from ``ROUNDS`` on
    it is longer than the entity."""
    if attempt >= ROUNDS and not kind.startswith(("given", "family", "ip")):
        more = 1 + (attempt - ROUNDS) // 4
        entity = entity[:1] * more + entity if kind == "email" else entity + entity[-1:] * more
    d = _Draw(key, kind, entity, attempt)
    if kind == "email":
        local, _, domain = entity.rpartition("@")
        host, _, top = domain.rpartition(".")
        return "".join(map(d.char, local)) + "@" + "".join(map(d.char, host)) + "." + top
    if kind == "phone" and entity.startswith("+"):  # the country code stays
        code, _, number = entity.partition(" ")
        return f"{code} " + "".join(map(d.char, number))
    if kind == "phone":
        return (entity[0] if entity[0] in "01" else str(2 + d.below(8))) + "".join(map(d.char, entity[1:]))
    if kind == "ip":
        low_high = {1: (1, 9), 2: (10, 99), 3: (100, 254)}
        spans = [low_high[len(o)] if attempt < ROUNDS // 2 else (1, 254) for o in entity.split(".")]
        return ".".join(str(a + d.below(b - a + 1)) for a, b in spans)
    if kind == "card":
        body = entity[0] + "".join(map(d.char, entity[1:]))
        return next(c for x in range(10) if luhn(c := body[:-1] + str(x))) if luhn(entity) else body
    if kind == "iban":
        rest = "".join(map(d.char, entity[4:]))
        return f"{entity[:2]}{98 - int(''.join(str(int(c, 36)) for c in rest + entity[:2] + '00')) % 97:02d}{rest}"
    if kind == "access_key":
        return entity[:4] + "".join(map(d.char, entity[4:]))
    if kind.startswith(("given", "family")):
        script = script_of(entity)
        if script == "OTHER":  # letters of the name's own alphabet
            block = [c for c in map(chr, range(ord(entity[0]) // 64 * 64, ord(entity[0]) // 64 * 64 + 64)) if c.isalpha()] or [entity[0]]
            return "".join(block[d.below(len(block))] for _ in range(max(len(entity), 2) + attempt // 8))
        syllables = _SYLLABLES[script]
        endings = _ENDINGS.get((script, kind)) or _ENDINGS.get((script, kind.split("_")[0])) or [""]
        return "".join(syllables[d.below(len(syllables))] for _ in range(2 + attempt // 3)) + endings[d.below(len(endings))]
    hexadecimal = kind == "secret" and not entity.isdigit() and all(c in "0123456789abcdefABCDEF" for c in entity)
    return "".join(d.char(c, hexadecimal) for c in entity)


def written(kind: str, raw: str, surrogate: str) -> str:
    """The surrogate in the layout of the mention ``raw``."""
    if kind.startswith(("given", "family")):
        return surrogate.upper() if raw.isupper() and len(raw) > 1 else "-".join(p[:1].upper() + p[1:] for p in surrogate.split("-"))
    if kind == "phone" and not surrogate.startswith("+"):
        surrogate = _country_code(raw) + surrogate
    if kind in ("phone", "card", "ssn", "iban"):
        rest = iter(c for c in surrogate if c.isalnum())
        return "".join(next(rest) if c.isalnum() else c for c in raw) + "".join(rest)
    if kind == "email" and len(raw) == len(surrogate):
        return "".join(s.upper() if c.isupper() else s for c, s in zip(raw, surrogate))
    return surrogate


_MENTIONS = "id long, text_hash long, start int, stop int, type string, entity string, raw string"


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "text_hash", "start", "stop", "type", "entity", "raw"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()]
    for batch in batches:
        rows = [(i, h, *m) for i, h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)) for m in mentions_of(t.as_py() or "")]
        columns = list(zip(*rows)) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def find_mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, start, stop, type, entity, raw) of every mention."""
    return docs.select(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col)), F.col(text_col)).mapInArrow(_detect, _MENTIONS)


def assign_surrogates(mentions: DataFrame, key: bytes) -> DataFrame:
    """(type, entity, surrogate): one distinct surrogate per distinct entity."""
    entities = shared_table(mentions.select("type", "entity").distinct(), "entities")

    def drawer(attempt: int):
        @F.pandas_udf(StringType())
        def drawn(kind: pd.Series, entity: pd.Series) -> pd.Series:
            return pd.Series([draw(key, k, e, attempt) for k, e in zip(kind, entity)], dtype=object)

        return drawn("type", "entity")

    real = entities.withColumnRenamed("entity", "surrogate")
    done, waiting = None, entities
    for attempt in count():
        tried = waiting.withColumn("surrogate", drawer(attempt)).join(real, ["type", "surrogate"], "left_anti")
        if done is not None:
            tried = tried.join(done.select("type", "surrogate"), ["type", "surrogate"], "left_anti")
        won = shared_table(tried.groupBy("type", "surrogate").agg(F.min("entity").alias("entity")).select("type", "entity", "surrogate"), "surrogates")
        done = won if done is None else done.unionByName(won)
        waiting = shared_table(waiting.join(won, ["type", "entity"], "left_anti"), "waiting")
        if waiting.isEmpty():
            return done


@F.pandas_udf(StringType())
def _written(kind: pd.Series, raw: pd.Series, surrogate: pd.Series) -> pd.Series:
    return pd.Series([written(k, r, s) for k, r, s in zip(kind, raw, surrogate)], dtype=object)


def replacements(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, entities): per document with mentions, the list of
    (start, stop, type, surrogate) in offsets of the original text."""
    mentions = shared_table(find_mentions(docs, id_col, text_col).distinct(), "mentions")
    found = mentions.join(assign_surrogates(mentions, key), ["type", "entity"])
    rows = found.select("id", "text_hash", F.struct("start", "stop", "type", _written("type", "raw", "surrogate").alias("surrogate")).alias("e"))
    return rows.groupBy("id", "text_hash").agg(F.array_sort(F.collect_list("e")).alias("entities"))  # one document's mentions


@F.pandas_udf(StringType())
def _replaced(text: pd.Series, entities: pd.Series) -> pd.Series:
    out = []
    for t, found in zip(text, entities):
        parts, at = [], 0
        for e in found if found is not None else ():
            parts += [t[at : e["start"]], e["surrogate"]]
            at = e["stop"]
        out.append(t if found is None else "".join([*parts, t[at:]]))
    return pd.Series(out, dtype=object)


def replace_entities(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", only_changed: bool = False) -> DataFrame:
    """``docs`` with every entity replaced, and ``entities``."""
    found = replacements(docs, key, id_col, text_col).select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("entities").alias("found"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    rows = keyed_rows(docs, id_col, text_col).join(found, same, "inner" if only_changed else "left")
    text = F.col("row").getField(text_col)
    none = F.array().cast("array<struct<start:int,stop:int,type:string,surrogate:string>>")
    safe = F.when(F.col("found").isNull(), text).otherwise(_replaced(text, F.col("found")))
    return unpacked(rows, docs.columns, **{text_col: safe, "entities": F.coalesce("found", none)})
