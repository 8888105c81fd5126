"""Substring dedup by hashing units of text (operator 3).

A text is cut into units (paragraphs, lines or clauses), each unit is
normalised (lower case, single spaces) and hashed. Digests are grouped over
the whole corpus; the occurrence that ranks first (smallest id, then text hash,
then offset) stays, all others are repeats, inside its document too. Adjacent
repeats of a document form a passage; passages of at least ``min_words`` words
are reported and removed, as spans of the original text.

Only digests travel, and the text next to a run that is to be extended. Within
a block of the input the first occurrence of a digest is sent on and the others
are repeats for sure, so a unit that a third of the documents hold reaches its
reducer once per block, not once per document. The reducers stream their sorted digests in one pass.

Defined results: null and blank texts have no units; rows that repeat both id
and text are one document; a null id ranks first and is reported as null; an
empty table gives no rows; other columns are ignored (kept by ``remove_spans``).
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerflow.llm.common import keyed_rows, shared_table, ship, unpacked

#: What separates units.
SEPARATORS = {"paragraph": r"\n[^\S\n]*(?:\n\s*)+", "line": r"\n", "clause": r"(?<=[.!?,;:])\s+|\n"}
_LINE, _PARAGRAPH = re.compile(SEPARATORS["line"]), re.compile(SEPARATORS["paragraph"])
#: Ids (16 bytes each) that are broadcast to choose texts before they are shuffled.
BROADCAST_IDS = 1_000_000
#: Units among which a task looks for repeats by itself.
BLOCK = 500_000
_NULL_ID = -(2**63)
_COLUMNS = ["digest", "id", "text_hash", "seq", "start", "stop", "words", "earlier", "e_hash", "e_start", "e_stop"]
_SCHEMA = "digest long, id long, text_hash long, seq int, start int, stop int, words int, earlier long, e_hash long, e_start int, e_stop int"
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
#: What is kept of a repeat's earlier occurrence: id, text hash, start, stop.
_EARLIER = [1, 2, 4, 5]
#: From this number on, units are whole lines and paragraphs.
WHOLE = 1 << 30
#: The least words of a run of equal clauses that is extended, and the
#: characters that the first round looks at on either side.
SEED_WORDS, REACH = 3, 160


def units_of(text: str, separator: re.Pattern, space: bytes = b"") -> list[tuple[int, int, bytes, int]]:
    """(start, stop, digest, words) of the units that have words; digests of
    other spaces differ."""
    found, start = [], 0
    for m in [*separator.finditer(text), None]:
        stop = m.start() if m else len(text)
        parts = text[start:stop].lower().split()
        if parts:
            found.append((start, stop, hashlib.blake2b(space + " ".join(parts).encode(), digest_size=8).digest(), len(parts)))
        start = m.end() if m else stop
    return found


def _batch(rows: np.ndarray, earlier: np.ndarray | None) -> pa.RecordBatch:
    """Rows (a 7-column table) as a batch; ``earlier`` marks sure repeats."""
    arrays = [pa.array(rows[:, k]).cast(t) for k, t in enumerate(_TYPES[:7])]
    arrays += [pa.array(earlier[:, k]).cast(t) if earlier is not None else pa.nulls(len(rows), t) for k, t in enumerate(_TYPES[7:])]
    return pa.RecordBatch.from_arrays(arrays, names=_COLUMNS)


def _split(rows: np.ndarray) -> list[pa.RecordBatch]:
    """First occurrences and sure repeats among ``rows``."""
    digest, key, text_hash, seq = (rows[:, k] for k in range(4))
    rows = rows[np.lexsort((seq, text_hash, key, digest))]
    same_unit = (rows[1:, :4] == rows[:-1, :4]).all(axis=1)  # of a repeated row
    rows = rows[np.r_[True, ~same_unit]]
    fresh = np.r_[True, rows[1:, 0] != rows[:-1, 0]]
    owner = rows[np.maximum.accumulate(np.where(fresh, np.arange(len(rows)), 0))][:, _EARLIER]
    return [b for b in (_batch(rows[fresh], None), _batch(rows[~fresh], owner[~fresh])) if len(b)]


def _digest(text: str, space: bytes = b"") -> bytes:
    return hashlib.blake2b(space + text.encode(), digest_size=8).digest()


def clauses_and_wholes(text: str, separator: re.Pattern) -> tuple[list[tuple], list[tuple]]:
    """The clauses of a text, and its lines and paragraphs of several lines in
    order, all as ``units_of`` gives them. A clause never goes over a line's
    end, so lines and paragraphs are put together from clauses."""
    clauses, words, start = [], [], 0
    for m in [*separator.finditer(text), None]:
        stop = m.start() if m else len(text)
        bare = " ".join(text[start:stop].lower().split())
        if bare:
            clauses.append((start, stop, _digest(bare), bare.count(" ") + 1))
            words.append(bare)
        start = m.end() if m else stop

    def joined(matches: Iterator[re.Match]) -> dict[tuple[int, int], tuple]:
        """The units between matches, by the range of their clauses."""
        found, k, start = {}, 0, 0
        for m in [*matches, None]:
            stop = m.start() if m else len(text)
            first = k
            while k < len(clauses) and clauses[k][0] < stop:
                k += 1
            if k > first:
                found[first, k] = (start, stop, _digest(" ".join(words[first:k]), b"\n"), sum(c[3] for c in clauses[first:k]))
            start = m.end() if m else stop
        return found

    lines = joined(_LINE.finditer(text))
    if len(lines) < 2:
        return clauses, list(lines.values())
    # a paragraph of one line is that line, whatever blanks stand around it
    several = [u for clause_range, u in joined(_PARAGRAPH.finditer(text)).items() if clause_range not in lines]
    return clauses, sorted([*lines.values(), *several])


def _units(unit: str, whole: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        separator = re.compile(SEPARATORS[unit])
        parts: list[np.ndarray] = []
        held = 0
        for batch in batches:
            keys, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for key, text_hash, text in zip(keys, hashes, batch.column(2)):
                found, wholes = clauses_and_wholes(text.as_py() or "", separator) if whole else (units_of(text.as_py() or "", separator), [])
                n = len(found)
                found += wholes
                if not found:
                    continue
                rows = np.empty((len(found), 7), np.int64)
                rows[:, 0] = np.frombuffer(b"".join(f[2] for f in found), "<i8")
                rows[:, 1], rows[:, 2], rows[:, 3] = key, text_hash, np.arange(len(found))
                rows[n:, 3] += WHOLE - n
                rows[:, 4:] = [(f[0], f[1], f[3]) for f in found]
                parts.append(rows)
                held += len(rows)
                if held >= BLOCK:
                    yield from _split(np.concatenate(parts))
                    parts, held = [], 0
        if parts:
            yield from _split(np.concatenate(parts))

    return run


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a partition sorted by digest and rank: all but each digest's first
    row, with the id of that one; sure repeats pass."""
    digest = rank = owner = None
    for batch in batches:
        rows = np.stack([batch.column(k).to_numpy() for k in range(7)], axis=1).astype(np.int64)
        if not len(rows):
            continue
        sure = batch.column(7).is_valid().to_numpy(zero_copy_only=False)
        yield batch.filter(pa.array(sure))
        rows = rows[~sure]
        if not len(rows):
            continue
        fresh = np.r_[digest != rows[0, 0], rows[1:, 0] != rows[:-1, 0]]
        at = np.maximum.accumulate(np.where(fresh, np.arange(len(rows)), -1))
        own = rows[at][:, _EARLIER]
        if owner is not None:
            own[at < 0] = owner
        before = rows[at, 1:4]
        if rank is not None:
            before[at < 0] = rank
        again = ~fresh & ~(rows[:, 1:4] == before).all(axis=1)  # not the first row itself
        if again.any():
            yield _batch(rows[again], own[again])
        digest, rank, owner = rows[-1, 0], before[-1], own[-1]


def _raw_marks(docs: DataFrame, id_col: str, text_col: str, unit: str, whole: bool = False) -> DataFrame:
    """The repeated units, each with its place and that of an earlier one; once
    for each row that repeats id and text."""
    ship(docs.sparkSession)
    text = F.col(text_col)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)), F.xxhash64(text), text).mapInArrow(_units(unit, whole), _SCHEMA)
    # sure repeats stay where they are; only first occurrences meet by digest
    route = F.when(F.col("earlier").isNull(), F.col("digest")).otherwise(F.xxhash64("id", "text_hash", "seq"))
    marks = rows.withColumn("route", route).repartition("route").drop("route").sortWithinPartitions("digest", "id", "text_hash", "seq").mapInArrow(_repeats, _SCHEMA)
    return shared_table(marks, "repeats")


def _marks(docs: DataFrame, id_col: str, text_col: str, unit: str) -> DataFrame:
    marks = _raw_marks(docs, id_col, text_col, unit)
    return marks.groupBy("id", "text_hash", "seq").agg(F.min(F.struct("start", "stop", "words", "earlier", "e_hash", "e_start", "e_stop")).alias("u")).select("id", "text_hash", "seq", "u.*")


def repeated_passages(docs: DataFrame, unit: str = "line", min_words: int = 25, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, start, stop, n_words, earlier_id): the passages to
    remove, with character offsets, and a document that has (the first unit
    of) the passage earlier."""
    marks = _marks(docs, id_col, text_col, unit)
    run = F.col("seq") - F.row_number().over(Window.partitionBy("id", "text_hash").orderBy("seq"))  # one document's units
    passages = marks.withColumn("run", run).groupBy("id", "text_hash", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("words").alias("n_words"), F.min(F.struct("seq", "earlier")).alias("first")
    )
    null = lambda c: F.when(F.col(c) != _NULL_ID, F.col(c))
    return passages.where(F.col("n_words") >= min_words).select(null("id").alias(id_col), "text_hash", "start", "stop", "n_words", null("first.earlier").alias("earlier_id"))


_WORD = re.compile(r"\S+")
_ASKED = "array<struct<kind: int, start: int, stop: int, other: long, o_hash: long, o_start: int, o_stop: int, left: boolean, right: boolean>>"
_CONTEXT = "id long, text_hash long, kind int, start int, stop int, other long, o_hash long, o_start int, o_stop int, first int, last int, before string, after string, left boolean, right boolean"
_RUN = "id long, text_hash long, start int, stop int, first int, last int, other long, o_hash long, o_start int, o_stop int, left boolean, right boolean"


_ASK = "id long, text_hash long, kind int, start int, stop int, other long, o_hash long, o_start int, o_stop int, left boolean, right boolean"
_ASK_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_()]


def _asks_of(m: np.ndarray) -> pa.RecordBatch:
    """From the sorted marks of whole documents (id, text_hash, seq, start,
    stop, words, earlier, e_hash, e_start, e_stop): a row of kind 0 for each run
    of repeated clauses, or one for either end if their earlier occurrences lie
    in different texts, and one of kind 2 for each line and paragraph."""
    m = m[np.r_[True, (m[1:, :3] != m[:-1, :3]).any(axis=1)]]
    whole, m = m[m[:, 2] >= WHOLE], m[m[:, 2] < WHOLE]
    made = [np.column_stack([whole[:, :2], np.full(len(whole), 2), whole[:, 3:5], whole[:, 6:10], np.zeros((len(whole), 2), np.int64)])]
    if len(m):
        first = np.flatnonzero(np.r_[True, (m[1:, :2] != m[:-1, :2]).any(axis=1) | (m[1:, 2] != m[:-1, 2] + 1)])
        last = np.r_[first[1:], len(m)] - 1
        long = np.add.reduceat(m[:, 5], first) >= SEED_WORDS
        a, b = m[first[long]], m[last[long]]
        together = (a[:, 6:8] == b[:, 6:8]).all(axis=1)
        for rows, left, right in ((together, 1, 1), (~together, 1, 0), (~together, 0, 1)):
            x, y = a[rows], b[rows]
            end = x if left else y
            sides = np.tile([left, right], (len(x), 1))
            made.append(np.column_stack([x[:, :2], np.zeros(len(x), np.int64), x[:, 3], y[:, 4], end[:, 6:9], (y if right else x)[:, 9], sides]))
    rows = np.concatenate(made)
    return pa.RecordBatch.from_arrays([pa.array(rows[:, k]).cast(t) for k, t in enumerate(_ASK_TYPES)], names=[c.split()[0] for c in _ASK.split(", ")])


def _asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_asks_of`` over a partition sorted by document; the last document of a
    batch waits for the next one."""
    held = np.zeros((0, 10), np.int64)
    for batch in batches:
        held = np.concatenate([held, np.column_stack([batch.column(k).to_numpy() for k in range(10)]).astype(np.int64)])
        if len(held):
            other = np.flatnonzero((held[:, :2] != held[-1, :2]).any(axis=1))
            done = int(other[-1]) + 1 if len(other) else 0
            if done:
                yield _asks_of(held[:done])
            held = held[done:]
    if len(held):
        yield _asks_of(held)


_CONTEXT_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.bool_()]


def _columns(columns: list, types: list, spec: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[c.split()[0] for c in spec.split(", ")])


def _contexts(reach: int):
    """What stands on either side of the asked places of each text, and their
    word numbers. ``left`` and ``right``: still to be extended there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            made: list[list] = [[] for _ in _CONTEXT_TYPES]
            asked = batch.column(3)
            ends = asked.offsets.to_pylist()
            kind, start, stop, other, o_hash, o_start, o_stop, left, right = (f.to_pylist() for f in asked.values.flatten())
            for k, (key, text_hash, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))):
                # rows that repeat id and text lie next to each other
                if (key, text_hash) == last:
                    continue
                last = key, text_hash
                t = text.as_py()
                words = [m.start() for m in _WORD.finditer(t)]
                for q in range(ends[k], ends[k + 1]):
                    a, b = start[q], stop[q]
                    low, high = max(0, a - reach), min(len(t), b + reach)
                    row = (
                        key, text_hash, kind[q], a, b, other[q], o_hash[q], o_start[q], o_stop[q], bisect_left(words, a), bisect_left(words, b),
                        t[low:a] if left[q] else "", t[b:high] if right[q] else "", left[q] and low > 0, right[q] and high < len(t),  # more text than this
                    )
                    for column, value in zip(made, row):
                        column.append(value)
            yield _columns(made, _CONTEXT_TYPES, _CONTEXT)

    return run


def _agree(mine: list[str], other: list[str]) -> int:
    n = 0
    for a, b in zip(mine, other):
        if a != b and a.lower() != b.lower():
            break
        n += 1
    return n


def _side(mine: str, other: str, more: tuple[bool, bool], back: bool) -> tuple[int, int, int, bool]:
    """(words, characters of mine, of the other, go on) that agree next to a
    run. Where a text goes on, its outermost word may be cut and waits."""
    found, sizes = [], []
    for text, cut in zip((mine, other), more):
        words = text.split()
        sizes.append(len(words))
        if back:
            words.reverse()
        found.append(words[:-1] if cut else words)
    n = _agree(*found)
    reach = [0, 0]
    if n:
        for k, text in enumerate((mine, other)):
            # the outermost word that agrees, counted from the text's beginning
            m = next(islice(_WORD.finditer(text), sizes[k] - n if back else n - 1, None))
            reach[k] = len(text) - m.start() if back else m.end()
    # an end that was not seen yet, and no word that differs
    return n, *reach, any(cut and n == len(w) for cut, w in zip(more, found)) and all(cut or n < len(w) for cut, w in zip(more, found))


_RUN_TYPES = [pa.int64()] * 2 + [pa.int32()] * 4 + [pa.int64()] * 2 + [pa.int32()] * 2 + [pa.bool_()] * 2


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _RUN.split(", ")]
    asked = ["before", "o_before", "after", "o_after", "left", "o_left", "right", "o_right"]
    for batch in batches:
        now = {c: batch.column(c).to_pylist() for c in [*names, *asked]}
        for k, (before, o_before, after, o_after, left, o_left, right, o_right) in enumerate(zip(*(now[c] for c in asked))):
            n, mine, theirs, go_on = _side(before, o_before, (left, o_left), True)
            now["start"][k] -= mine
            now["o_start"][k] -= theirs
            now["first"][k] -= n
            now["left"][k] = go_on
            n, mine, theirs, go_on = _side(after, o_after, (right, o_right), False)
            now["stop"][k] += mine
            now["o_stop"][k] += theirs
            now["last"][k] += n
            now["right"][k] = go_on
        yield _columns([now[c] for c in names], _RUN_TYPES, _RUN)


def _merged(spans: list[tuple]) -> list[list]:
    """Overlapping or touching (first, last, start, stop, earlier) as one."""
    out: list[list] = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1]:
            out[-1][1], out[-1][3] = max(out[-1][1], s[1]), max(out[-1][3], s[3])
        else:
            out.append(list(s))
    return out


def _passages(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [("id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("n_words", pa.int64()), ("earlier", pa.int64())]
        for batch in batches:
            made = []
            for key, text_hash, spans in zip(*(batch.column(k).to_pylist() for k in range(3))):
                parts = {w: [(s["first"], s["last"], s["start"], s["stop"], s["other"]) for s in spans if s["whole"] == w] for w in (False, True)}
                long = [tuple(s) for s in _merged(parts[False]) if s[1] - s[0] >= min_words]
                made += [(key, text_hash, s[2], s[3], s[1] - s[0], s[4]) for s in _merged(long + parts[True])]
            columns = zip(*made) if made else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, types)], names=[n for n, _ in types])

    return run


def extended_passages(docs: DataFrame, min_words: int = 25, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``repeated_passages``, by words: runs of repeated clauses (of
    ``SEED_WORDS`` words or more) are extended word by word on both sides while
    the text of their earlier occurrence agrees, and count from ``min_words``
    on; repeated whole lines and paragraphs count whatever their length. A
    passage that holds no whole clause of the earlier text is not found."""
    marks = _raw_marks(docs, id_col, text_col, "clause", True).select("id", "text_hash", "seq", "start", "stop", "words", "earlier", "e_hash", "e_start", "e_stop")
    asked = marks.repartition("id", "text_hash").sortWithinPartitions("id", "text_hash", "seq", "earlier", "e_hash", "e_start", "e_stop").mapInArrow(_asks, _ASK)
    asked = shared_table(asked, "asked")
    yes, no = F.lit(True), F.lit(False)
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    open_runs, done, reach = asked, [], REACH
    while True:
        mine = open_runs.where("kind = 0")
        theirs = mine.select(F.col("other").alias("id"), F.col("o_hash").alias("text_hash"), F.col("o_start").alias("start"), F.col("o_stop").alias("stop"), "left", "right").distinct()
        for c, t in (("kind", F.lit(1)), ("other", F.lit(0)), ("o_hash", F.lit(0)), ("o_start", F.lit(0)), ("o_stop", F.lit(0))):
            theirs = theirs.withColumn(c, t)
        fields = ["kind", "start", "stop", "other", "o_hash", "o_start", "o_stop", "left", "right"]
        wanted = open_runs.unionByName(theirs).groupBy("id", "text_hash").agg(F.collect_set(F.struct(*fields)).cast(_ASKED).alias("asked"))
        wanted = shared_table(wanted, "wanted")
        # the texts that nothing is asked of stay where they are
        few = texts.join(F.broadcast(wanted.select("id", "text_hash")), ["id", "text_hash"], "left_semi") if wanted.count() <= BROADCAST_IDS else texts
        rows = few.hint("merge").join(wanted, ["id", "text_hash"]).select("id", "text_hash", "text", "asked").sortWithinPartitions("id", "text_hash")
        found = shared_table(rows.mapInArrow(_contexts(reach), _CONTEXT), "contexts")
        done.append(found.where("kind = 2").select("id", "text_hash", "first", "last", "start", "stop", "other", yes.alias("whole")))
        # the sides that were asked for tell places apart; both texts hold them
        side = lambda f: f.where("kind = 1").select(F.col("id").alias("other"), F.col("text_hash").alias("o_hash"), F.col("start").alias("o_start"), F.col("stop").alias("o_stop"), F.col("before").alias("o_before"), F.col("after").alias("o_after"), F.col("left").alias("o_left"), F.col("right").alias("o_right"))
        pairs = found.where("kind = 0").join(side(found), ["other", "o_hash", "o_start", "o_stop"])
        longer = shared_table(pairs.mapInArrow(_extend, _RUN), "extended")
        done.append(longer.select("id", "text_hash", "first", "last", "start", "stop", "other", no.alias("whole")))
        open_runs = longer.where("left or right").withColumn("kind", F.lit(0)).select("id", "text_hash", *fields)
        if open_runs.isEmpty():
            break
        reach *= 10
    spans = done[0]
    for d in done[1:]:
        spans = spans.unionByName(d)
    spans = spans.groupBy("id", "text_hash").agg(F.collect_set(F.struct("first", "last", "start", "stop", "other", "whole")).alias("spans"))
    passages = spans.mapInArrow(_passages(min_words), "id long, text_hash long, start int, stop int, n_words long, earlier long")
    null = lambda c: F.when(F.col(c) != _NULL_ID, F.col(c))
    return passages.select(null("id").alias(id_col), "text_hash", "start", "stop", "n_words", null("earlier").alias("earlier_id"))


@F.pandas_udf(StringType())
def _without(text: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for t, cut in zip(text, spans):
        if cut is None:  # evaluated, though not used
            out.append(t)
            continue
        kept, at = [], 0
        for s in sorted((s["start"], s["stop"]) for s in cut):
            kept.append(t[at : s[0]])
            at = s[1]
        out.append("".join([*kept, t[at:]]))
    return pd.Series(out, dtype=object)


def remove_spans(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the passages cut out of ``text_col``, and ``removed``: the
    spans, in offsets of the original text."""
    cuts = passages.groupBy(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash")).agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("cut"))
    rows = keyed_rows(docs, id_col, text_col)
    rows = rows.join(cuts, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    text = F.col("row").getField(text_col)
    kept = F.when(F.col("cut").isNull(), text).otherwise(_without(text, F.col("cut")))
    return unpacked(rows, docs.columns, **{text_col: kept, "removed": F.coalesce("cut", F.array().cast("array<struct<start:int,stop:int>>"))})
