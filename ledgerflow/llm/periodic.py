"""Periodic runs of words by string synchronising sets (operator 12).

A run is a stretch of consecutive words whose smallest period q (words q
apart are identical) fits into it at least three times, that is at least 24
words long, and that no neighbouring word extends. They are found at dyadic
scales t = 4, 8, 16, ...; the scale t answers for the periods from 2t to 4t:

* Every window of t words has a 64-bit hash, doubled from scale to scale.
  Position i is selected when the least hash of the windows that begin in
  [i, i + t] is that of the first or of the last one. So equal contexts of 2t
  words are selected alike, and a stretch without a selected position has a
  period of at most t / 3. Windows with such a period are left out of the
  minimum: they lie in runs that smaller scales have found.
* In a run of period q, with c = 2.5t, 3t, 3.5t or 4t the first that is not
  below q, some selected position i and i + q both begin a context of c words
  inside the run, and as c >= q no nearer one is equal to it. So next
  neighbours among the selected positions with equal contexts propose every
  period, and few others.
* A proposal is extended word by word in both directions. Only identical
  words count, so hashes never decide a result alone.
* Periods below 8 are detected directly, by comparing words so far apart; they
  are the highly periodic regions of the first scales.

Documents are handled together, about ``CHUNK_BYTES`` of text at a time,
separated by words of their own and ordered by length, so that a scale sees
only the documents that can hold its periods. Time is O(n log n) comparisons
and O(n log^2 n) for the sliding minima; nothing meets across documents, so
the operator is map-only.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; a null or empty text, or
one of blanks alone, has no words, no runs and an empty collapsed text; rows
are independent, so rows that repeat an id each have a result; an empty table
gives no rows; other columns are kept as they are (a column named like a
result is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import ship, unpacked
from ledgerflow.llm.shingles import mix

CHUNK_BYTES = 1 << 22
#: Fixed values of the definition of a run.
MIN_WORDS, MIN_EXPONENT = 24, 3
_FIRST = 4  # the first scale; periods from 2 * _FIRST on
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_NONE = _U(0xFFFFFFFFFFFFFFFF)

Runs = np.ndarray  # rows of (start, stop, period)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a hash followed by another."""
    return mix(a * _BASE + b)


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and behind-last index of the stretches of True."""
    edge = np.diff(np.concatenate([[0], equal.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _direct(w: np.ndarray) -> Runs:
    """All maximal stretches of period below 2 * _FIRST that hold it three
    times or more, each under its smallest period."""
    found, seen = [np.zeros((0, 3), np.int64)], np.zeros(0, np.int64)
    for p in range(1, min(2 * _FIRST, len(w))):
        a, b = _stretches(w[:-p] == w[p:])
        long = b - a >= (MIN_EXPONENT - 1) * p
        a, b = a[long], b[long] + p
        ends = a * (len(w) + 1) + b
        new = ~np.isin(ends, seen)
        seen = np.concatenate([seen, ends[new]])
        found.append(np.stack([a[new], b[new], np.full(new.sum(), p)], axis=1))
    return np.concatenate(found)


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        a = np.minimum(a[:-size], a[size:])
        size *= 2
    rest = width - size
    return np.minimum(a[:-rest], a[rest:]) if rest else a


def selected(h: np.ndarray, t: int, runs: Runs) -> np.ndarray:
    """The synchronising set of scale ``t``: ``h`` has the hashes of the
    windows of ``t`` words, ``runs`` the runs of smaller periods."""
    order = h.copy()
    dense = runs[(3 * runs[:, 2] <= t) & (runs[:, 1] - runs[:, 0] >= t)]
    if len(dense):
        step = np.zeros(len(h) + 1, np.int64)
        np.add.at(step, dense[:, 0], 1)
        np.add.at(step, dense[:, 1] - t + 1, -1)
        order[np.cumsum(step[:-1]) > 0] = _NONE
    least = _sliding_min(order, t + 1)
    return np.flatnonzero((least != _NONE) & ((order[:-t] == least) | (order[t:] == least)))


def _neighbours(at: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and the distance to the next one with an equal context."""
    o = np.argsort(context, kind="stable")
    same = context[o][1:] == context[o][:-1]
    first, second = at[o][:-1][same], at[o][1:][same]
    return first, second - first


def _proposals(at: np.ndarray, h2: np.ndarray, t: int) -> np.ndarray:
    """(period, position, context) proposed by scale ``t``; ``h2`` has the
    hashes of the windows of 2t words."""
    # a position whose 2t words do not come again within 4t proposes nothing
    first, gap = _neighbours(at, h2[at])
    near = gap <= 4 * t
    at = np.union1d(first[near], (first + gap)[near])
    out = [np.zeros((0, 3), np.int64)]
    for c in (5 * t // 2, 3 * t, 7 * t // 2, 4 * t):
        inside = at[at + c - 2 * t < len(h2)]
        i, q = _neighbours(inside, _pair(h2[inside], h2[inside + c - 2 * t]))
        fits = (q > c - t // 2) & (q <= c) | (q == 2 * t) & (2 * c == 5 * t)
        out.append(np.stack([q[fits], i[fits], np.full(fits.sum(), c)], axis=1))
    found = np.concatenate(out)
    found = found[np.lexsort((found[:, 1], found[:, 0]))]
    # of a chain of overlapping equal contexts the first one will do
    again = (found[1:, 0] == found[:-1, 0]) & (found[1:, 1] <= found[:-1, 1] + found[:-1, 2])
    return found[np.concatenate([[True], ~again])] if len(found) else found


def _equal_until(w: np.ndarray, i: int, q: int) -> int:
    """The first j >= i with w[j] != w[j + q]; the last word is a separator."""
    step = 64
    while True:
        b = w[i + q : i + q + step]
        differ = w[i : i + len(b)] != b
        k = int(differ.argmax())
        if differ[k]:
            return i + k
        i += step
        step *= 2


def _equal_from(w: np.ndarray, i: int, q: int) -> int:
    """The least j such that w[k] == w[k + q] for j <= k < i; the first word is
    a separator."""
    step = 64
    while True:
        a = max(0, i - step)
        differ = (w[a:i] != w[a + q : i + q])[::-1]
        k = int(differ.argmax())
        if differ[k]:
            return i - k
        i = a
        step *= 2


def _extended(w: np.ndarray, proposals: np.ndarray) -> list[tuple[int, int, int]]:
    out, reached = [], (0, 0)
    for q, i, c in proposals.tolist():
        if reached[0] == q and i < reached[1]:
            continue
        stop = _equal_until(w, i + c, q)
        start = _equal_from(w, i, q)
        reached = (q, stop)
        if stop - start >= (MIN_EXPONENT - 1) * q:
            out.append((start, stop + q, q))
    return out


def find_runs(ids: np.ndarray, sizes: np.ndarray) -> Runs:
    """The runs in ``ids``: a separator (a number found once), then for every
    document, in ascending order of ``sizes``, its words' numbers and a separator."""
    runs = _direct(ids)
    ends = set(zip(runs[:, 0].tolist(), runs[:, 1].tolist()))
    firsts = np.concatenate([[0], np.cumsum(sizes + 1)])  # the separator before each document
    h = mix(ids.astype(_U))
    for k in (1, 2):
        h = _pair(h[:-k], h[k:]) if len(h) > k else h[:0]
    t, off = _FIRST, 0
    while True:
        d = int(np.searchsorted(sizes, 6 * t))  # documents that can hold the period 2t three times
        if d == len(sizes):
            break
        h, off = h[firsts[d] - off :], int(firsts[d])
        h2 = _pair(h[:-t], h[t:])
        here = runs[runs[:, 0] >= off] - np.array([off, off, 0])
        w = ids[off:]
        new = [(s + off, e + off, q) for s, e, q in _extended(w, _proposals(selected(h, t, here), h2, t)) if (s + off, e + off) not in ends]
        # within one scale a stretch can have just one period
        ends.update((s, e) for s, e, _ in new)
        runs = np.concatenate([runs, np.array(sorted(set(new)), np.int64).reshape(-1, 3)])
        h, t = h2, 2 * t
    return runs[runs[:, 1] - runs[:, 0] >= MIN_WORDS]


def runs_of(texts: list[list[bytes]]) -> list[Runs]:
    """For each list of words its runs as (start, stop, period), in order."""
    order = sorted(range(len(texts)), key=lambda k: len(texts[k]))
    known: dict[bytes, int] = {}
    ids = [-1]
    for n, k in enumerate(order):
        ids += [known.setdefault(w, len(known)) for w in texts[k]]
        ids.append(-2 - n)
    sizes = np.array([len(texts[k]) for k in order], np.int64)
    runs = find_runs(np.array(ids, np.int64), sizes)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    firsts = np.concatenate([[0], np.cumsum(sizes + 1)]) + 1
    cut = np.searchsorted(runs[:, 0], firsts)
    out: list[Runs] = [runs[:0]] * len(texts)
    for n, k in enumerate(order):
        if cut[n + 1] > cut[n]:
            out[k] = runs[cut[n] : cut[n + 1]] - np.array([firsts[n], firsts[n], 0])
    return out


def collapsed(words: list[bytes], runs: Runs) -> bytes:
    """The words joined by blanks, of each run only its first period."""
    if not len(runs):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 1], -1)
    return b" ".join(words[k] for k in np.flatnonzero(np.cumsum(step[:-1]) == 0))


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text").cast(pa.binary())
        sizes = np.diff(np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1]) if len(text) else []
        chunk = np.cumsum(sizes, dtype=np.int64) // CHUNK_BYTES
        for first, stop in zip(np.flatnonzero(np.diff(chunk, prepend=-1)), np.flatnonzero(np.diff(chunk, append=-1)) + 1):
            # bytes.split() splits at the six ASCII blanks, no others
            words = [(t or b"").split() for t in text.slice(first, stop - first).to_pylist()]
            runs = runs_of(words)
            found = [[{"start": s, "length": e - s, "period": q} for s, e, q in r.tolist()] for r in runs]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").slice(first, stop - first), pa.array([len(w) for w in words], pa.int64()), pa.array(found, _RUNS),
                    pa.array([collapsed(w, r) for w, r in zip(words, runs)], pa.binary()).cast(pa.string()),
                ],
                names=["row", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without ``text_col``, with ``n_words``, ``runs`` (an array of
    start, length, period, in words, by start and period) and ``collapsed``
    (the words joined by one blank, where of each run only the first period
    stays)."""
    ship(docs.sparkSession)
    rest = [c for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType().add("row", packed.schema["row"].dataType).add("n_words", "long").add("runs", T.ArrayType(run)).add("collapsed", "string")
    found = packed.mapInArrow(_found, schema)
    return unpacked(found, rest, n_words=F.col("n_words"), runs=F.col("runs"), collapsed=F.col("collapsed"))
