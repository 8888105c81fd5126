"""License scan: exact phrases and fuzzy short notices (operator 1).

Texts are reduced to words (ASCII letters lower-cased; everything but ASCII
digits, letters and non-ASCII characters separates) joined by one space.

* Phrases: every place where their words stand consecutively.
* Notices: a notice within ``k`` edits holds at least one of its ``k + 1``
  pieces unchanged (pigeonhole), so an Aho-Corasick pass over all pieces
  locates every candidate; only the few characters around a candidate go to
  the ``regex`` library, whose bounded-error match verifies the edits and
  gives the span.

Each document is scanned on its own: one narrow pass, no shuffle.

Defined results: a null or empty text has no words, spans or labels and scores
0; repeated rows each get their result; an empty table gives no rows; the id
is passed through (null stays null); other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: phrase -> label, matched exactly
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: notice -> label, matched with up to one edit per ``EDIT_CHARS`` characters.
#: Words in brackets tell it from other notices: they allow one edit per three
#: letters, and those that allow none are whole words.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the apache license version [1] [1]": "apache-1.1",
    "licensed under the apache license version [1] [0]": "apache-1.0",
    "released under the [mit] license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under cc [by]": "cc-by",
    "licensed under cc by [nc]": "cc-by-nc",
    "licensed under cc by [sa]": "cc-by-sa",
    "licensed under cc by [nd]": "cc-by-nd",
    "licensed under cc by [nc] [sa]": "cc-by-nc-sa",
    "licensed under cc by [nc] [nd]": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noderivs": "cc-by-nd",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution noncommercial sharealike": "cc-by-nc-sa",
    "creative commons attribution noncommercial noderivs": "cc-by-nc-nd",
    "creative commons attribution noncommercial noderivatives": "cc-by-nc-nd",
    "redistribution and use in source and binary forms": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "reserved",
}
EDIT_CHARS = 10
#: Notices' lengths that are searched at once.
_PIECE = 8

_SEPARATE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_SEPARATE = _SEPARATE.translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))


def words_of(text: str) -> bytes:
    """Words of ``text`` between single spaces, with one at either end."""
    return b" " + b" ".join(text.encode().translate(_SEPARATE).split()) + b" "


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    edits: int
    pieces: tuple[tuple[int, str], ...]  # (offset, piece)
    pattern: str


def _pattern(marked: str, edits: int) -> str:
    """The best match of a notice, with the bounds of its bracketed words."""
    made, parts = "(?b)", re.split(r"\[(.*?)\]", marked)
    for i, part in enumerate(parts):
        if i % 2 == 0:
            made += f"(?:{re.escape(part)}){{e<={edits}}}" if part else ""
        elif len(part) >= 3:
            made += f"(?:{re.escape(part)}){{e<={len(part) // 3}}}"
        else:  # only the space before it may be missing
            before = "".join(parts[:i]).split()[-1:]
            made += f"(?<=^|{'|'.join([' ', *map(re.escape, before)])}){re.escape(part)}(?= )"
    return made


def _notice(marked: str, label: str, edit_chars: int) -> Notice:
    text = marked.replace("[", "").replace("]", "")
    k = len(text) // edit_chars
    cuts = [len(text) * i // (k + 1) for i in range(k + 2)]
    return Notice(text, label, k, tuple((a, text[a:b]) for a, b in zip(cuts, cuts[1:])), _pattern(marked, k))


class Scanner:
    """Finds phrases and notices in one text after another."""

    def __init__(self, phrases: dict[str, str], notices: dict[str, str], edit_chars: int) -> None:
        import ahocorasick
        import regex

        self.phrases = [(b" " + p.encode() + b" ", label) for p, label in phrases.items()]
        self.notices = [_notice(t, label, edit_chars) for t, label in notices.items()]
        self.patterns = [regex.compile(n.pattern) for n in self.notices]
        self.longer = [[o.text.startswith(n.text + " ") for o in self.notices] for n in self.notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, n in enumerate(self.notices):
            for offset, piece in n.pieces:
                seeds.setdefault(piece, []).append((k, offset))
        self.seeds = ahocorasick.Automaton()
        for piece, at in seeds.items():
            self.seeds.add_word(piece, (len(piece), at))
        self.seeds.make_automaton()

    def exact(self, words: bytes) -> list[tuple[int, str]]:
        """(word number, label) of every place of every phrase."""
        places = []
        for phrase, label in self.phrases:
            at, n, counted = words.find(phrase), 0, 0
            while at >= 0:
                n, counted = n + words.count(b" ", counted, at), at
                places.append((n, label))
                at = words.find(phrase, at + 1)
        return places

    def windows(self, words: str) -> dict[int, list[list[int]]]:
        """Per notice the merged stretches in which it can stand."""
        found: dict[int, list[list[int]]] = {}
        for end, (size, at) in self.seeds.iter(words):
            for k, offset in at:
                n = self.notices[k]
                start = end + 1 - size - offset
                a, b = max(0, start - n.edits), min(len(words), start + len(n.text) + n.edits + 1)
                found.setdefault(k, []).append([a, b])
        for k, spans in found.items():
            merged: list[list[int]] = []
            for a, b in sorted(spans):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            found[k] = merged
        return found

    def places(self, k: int, words: str, a: int, b: int) -> Iterator[tuple[int, int, int]]:
        """(start, stop, edits) of a notice's places in a stretch, however
        long: it is read from left to right in pieces of ``_PIECE`` notices.
        What ends in the last notice's length of a piece might go on or be
        beaten behind it, and is searched again with the next piece."""
        size = len(self.notices[k].text) + 2 * self.notices[k].edits
        while b - a > _PIECE * size:
            sure, done = a + (_PIECE - 1) * size, a
            for start, stop, edits in self._best_first(k, words, a, a + _PIECE * size):
                if stop <= sure:
                    yield start, stop, edits
                    done = max(done, stop)
            a = max(done, sure - size)
        yield from self._best_first(k, words, a, b)

    def _best_first(self, k: int, words: str, a: int, b: int) -> Iterator[tuple[int, int, int]]:
        """The best match of a stretch, then those before and behind it."""
        stretches = [(a, b)]
        while stretches:
            a, b = stretches.pop()
            m = self.patterns[k].search(words, a, b)
            if m is None or not (text := m.group().strip()):
                continue
            start = m.start() + len(m.group()) - len(m.group().lstrip())
            stop = start + len(text)
            if (edits := sum(m.fuzzy_counts)) <= self.notices[k].edits:  # of all parts together
                yield start, stop, edits
            stretches += [(a, start), (stop, b)]

    def fuzzy(self, words: str) -> list[tuple[str, int, int, int, float]]:
        """(label, first word, last word, edits, similarity) of every notice."""
        found = [(k, *place) for k, windows in sorted(self.windows(words).items()) for a, b in windows for place in self.places(k, words, a, b)]
        if not found:
            return []
        spaces = [m.start() for m in re.finditer(" ", words)]
        spans = []
        for k, start, stop, edits in found:
            n = self.notices[k]
            spans.append((n.label, bisect_left(spaces, start + 1) - 1, bisect_left(spaces, stop) - 1, edits, 1 - edits / len(n.text), k))
        # a notice that goes on as a longer one is that one; of others that claim the same words, the nearest has them
        whole = [s for s, near in _meeting(spans) if not any(self.longer[s[5]][o[5]] for o in near)]
        return [s[:5] for s, near in _meeting(whole) if not any(o[4] > s[4] for o in near)]


def _meeting(spans: list[tuple]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Each span, by its first word, with those that share a word with it."""
    spans = sorted(spans, key=lambda s: s[1:3])
    reach = max((s[2] - s[1] for s in spans), default=0)
    low = 0
    for i, s in enumerate(spans):
        while spans[low][1] < s[1] - reach:
            low += 1
        high = i
        while high < len(spans) and spans[high][1] <= s[2]:
            high += 1
        yield s, [o for o in spans[low:high] if o is not s and o[2] >= s[1]]


@lru_cache(maxsize=2)
def scanner(phrases: tuple, notices: tuple, edit_chars: int) -> Scanner:
    return Scanner(dict(phrases), dict(notices), edit_chars)


_SPAN = "label: string, first: bigint, last: bigint, edits: int, similarity: double"
SCHEMA = f"id long, n_words long, phrases array<struct<word: bigint, label: string>>, notices array<struct<{_SPAN}>>"
_KINDS = [
    pa.int64(),
    pa.int64(),
    pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())])),
    pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("edits", pa.int32()), ("similarity", pa.float64())])),
]


def scan_licenses(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, edit_chars: int = EDIT_CHARS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: id, n_words, every phrase place, every notice span (word
    numbers from 0, edits, similarity)."""
    args = (tuple(phrases.items()), tuple(notices.items()), edit_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(*args)
        for batch in batches:
            counts, exact, fuzzy = [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py() or "")
                counts.append(max(0, words.count(b" ") - 1) if len(words) > 2 else 0)
                exact.append([{"word": w, "label": x} for w, x in scan.exact(words)])
                fuzzy.append([dict(zip(("label", "first", "last", "edits", "similarity"), s)) for s in scan.fuzzy(words.decode())])
            columns = [pa.array(c, k) for c, k in zip((counts, exact, fuzzy), _KINDS[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "n_words", "phrases", "notices"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, SCHEMA).withColumnRenamed("id", id_col)


def license_report(scan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, labels and a score in [0, 1] per document from the spans."""
    places = F.transform("phrases", lambda p: p["word"])
    base = F.array_sort(F.array_distinct(F.transform("phrases", lambda p: p["label"])))
    every = F.array_sort(F.array_distinct(F.concat(F.transform("phrases", lambda p: p["label"]), F.transform("notices", lambda s: s["label"]))))
    best = F.array_max(F.transform("notices", lambda s: s["similarity"]))
    return scan.select(
        id_col,
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
        "notices",
    )
