"""Document quality from a linear-chain CRF over lines (operator 5).

Each line is good or bad. A line is seen through statistics of itself and of
the lines before and after it; the chain's transition weights make neighbours
agree. The CRF is fitted by gradient ascent on the log-likelihood (numpy, on a
bounded sample, a document's label standing for each of its lines). Scoring
runs forward-backward over every line of every document inside the tasks, and
the length-weighted mean of the lines' marginals is the document's score.

Defined results: a null text is an empty one, which is one empty line with a
marginal like any other; repeated rows score alike; a null id is passed
through; an empty table gives no rows; without labelled rows of both kinds the
model has zero weights and every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerflow.llm.labelled import collect_sorted, sample_labels, sample_texts

_SYMBOLS = b"#*$%&|<>{}[]=/\\_~^@+"
_DIGITS = b"0123456789"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Statistics of one line, in this order; each line also sees its neighbours'.
STATISTICS = (
    "log_words", "word_length", "distinct", "echo", "symbols", "digits", "upper", "punctuated", "ends", "odd_words", "longest", "empty", "repeated", "few_distinct", "some_symbols",
)
WIDTH = 3 * len(STATISTICS) + 1


def _line(line: str, seen: set[str]) -> tuple[float, ...]:
    words = line.split()
    n = len(words)
    if not n:
        return (0.0,) * 11 + (1.0, 0.0, 0.0, 0.0)
    raw = line.encode()
    chars = len(raw)
    share = lambda kinds: (chars - len(raw.translate(None, kinds))) / chars
    sizes = list(map(len, words))
    distinct = len(set(words)) / n
    echo = sum(a == b for a, b in zip(words, words[1:])) / n
    symbols = share(_SYMBOLS)
    ended = sum(w[-1] in ".,;:!?" for w in words) / n
    odd = sum(not w[0].isalpha() for w in words) / n
    again = line in seen
    seen.add(line)
    return (
        math.log1p(n), sum(sizes) / n / 10, distinct, echo, symbols, share(_DIGITS), share(_UPPER), ended, float(words[-1][-1] in ".!?"), odd, min(max(sizes), 60) / 20, 0.0, float(again), float(distinct < 0.5 and n > 4), float(symbols > 0.02),
    )


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x WIDTH features, line lengths) of one text."""
    lines = (text or "").split("\n")
    seen: set[str] = set()
    own = np.array([_line(x, seen) for x in lines], dtype=np.float32)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    weights = np.array([max(1, len(x)) for x in lines], dtype=np.float64)
    return np.hstack([own, before, after, np.ones((len(own), 1), np.float32)]), weights


@dataclass
class Crf:
    """Weights of "good" over "bad" for a line, and of the four transitions."""

    weights: np.ndarray
    transitions: np.ndarray  # [from, to]; 0 bad, 1 good

    def marginals(self, scores: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Forward-backward over many chains at once: P(good) of every line,
        each chain's log partition, and the expected transitions per chain.

        Chains are sorted by length; step ``t`` touches those longer than
        ``t``, so time and memory follow the number of lines.
        """
        order = np.argsort([-len(s) for s in scores], kind="stable")
        sizes = np.array([len(scores[k]) for k in order])
        steps = int(sizes[0]) if len(sizes) else 0
        alive = np.searchsorted(-sizes, -np.arange(1, steps + 1), side="right") if steps else np.zeros(0, int)
        first = np.concatenate([[0], np.cumsum(alive)])
        flat = np.zeros(int(first[-1]))
        rank = np.empty(len(order), int)
        rank[order] = np.arange(len(order))
        for k, s in enumerate(scores):
            flat[first[: len(s)] + rank[k]] = s
        t = self.transitions
        fwd = np.zeros((len(flat), 2))
        bwd = np.zeros((len(flat), 2))
        for i in range(steps):
            a, n = first[i], alive[i]
            emit = flat[a : a + n]
            if i:
                p = fwd[first[i - 1] : first[i - 1] + n]
                fwd[a : a + n, 0] = np.logaddexp(p[:, 0] + t[0, 0], p[:, 1] + t[1, 0])
                fwd[a : a + n, 1] = np.logaddexp(p[:, 0] + t[0, 1], p[:, 1] + t[1, 1]) + emit
            else:
                fwd[a : a + n, 1] = emit
        edges = np.zeros((len(order), 2, 2))
        total = np.zeros(len(order))
        for i in range(steps - 1, -1, -1):
            a, n = first[i], alive[i]
            nxt = alive[i + 1] if i + 1 < steps else 0
            total[nxt:n] = np.logaddexp(fwd[a + nxt : a + n, 0], fwd[a + nxt : a + n, 1])
            if nxt:
                b = first[i + 1]
                f, g, e = fwd[a : a + nxt], bwd[b : b + nxt], flat[b : b + nxt]
                into = np.stack([g[:, 0], g[:, 1] + e], axis=1)
                for x in (0, 1):
                    bwd[a : a + nxt, x] = np.logaddexp(t[x, 0] + into[:, 0], t[x, 1] + into[:, 1])
                    for y in (0, 1):
                        edges[:nxt, x, y] += np.exp(f[:, x] + t[x, y] + into[:, y] - total[:nxt])
        gap = fwd[:, 1] + bwd[:, 1] - fwd[:, 0] - bwd[:, 0]
        good = 1 / (1 + np.exp(-np.clip(gap, -50, 50)))
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return [good[first[: len(s)] + back[k]] for k, s in enumerate(scores)], total[back], edges[back]

    def score(self, features: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
        """Length-weighted mean marginal of each document."""
        good, _, _ = self.marginals([x @ self.weights for x in features])
        return np.array([float(np.average(g, weights=w)) for g, w in zip(good, weights)])


def fit(features: list[np.ndarray], labels: list[int], steps: int = 120, rate: float = 0.15, decay: float = 1e-3) -> Crf:
    """Maximise the mean per-line log-likelihood of the chains (Adam)."""
    model = Crf(np.zeros(WIDTH), np.zeros((2, 2)))
    if len(set(labels)) < 2:
        return model
    y = np.array(labels, dtype=np.float64)
    sizes = np.array([len(f) for f in features], dtype=np.float64)
    rows = np.concatenate(features).astype(np.float64)
    chain = np.repeat(np.arange(len(features)), sizes.astype(int))
    cuts = np.cumsum(sizes.astype(int))[:-1]
    share = 1 / np.sqrt(sizes)  # a long document counts more, but not by its length
    share /= share.sum()
    seen = (sizes - 1) * share
    told = np.array([[((1 - y) * seen).sum(), 0.0], [0.0, (y * seen).sum()]])
    theta = np.zeros(WIDTH + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        model = Crf(theta[:WIDTH], theta[WIDTH:].reshape(2, 2))
        good, _, edges = model.marginals(np.split(rows @ model.weights, cuts))
        gap = (y[chain] - np.concatenate(good)) * share[chain]
        grad = np.concatenate([rows.T @ gap, (told - (edges * share[:, None, None]).sum(0)).ravel()]) - decay * theta
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Crf(theta[:WIDTH], theta[WIDTH:].reshape(2, 2))


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: tuple[int, int] = (1500, 2500), max_chars: int = 100_000, parts: int = 5, held_out: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> Crf:
    """Fit on at most ``rows`` documents labelled 0 and 1 of the learning
    folds, each at most ``max_chars`` long. Their line statistics are made in the tasks; the driver gets those alone."""
    sample = sample_texts(docs, sample_labels(labels, label_col, rows, parts, held_out, id_col), max_chars, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [line_features(t.as_py())[0][:, : len(STATISTICS)].astype("<f4").tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(made, pa.binary())], names=["id", "label", "own"])

    frame = collect_sorted(sample.mapInArrow(run, "id long, label int, own binary"), "id", "own")
    features = []
    for raw in frame["own"]:
        own = np.frombuffer(raw, "<f4").reshape(-1, len(STATISTICS))
        before, after = np.zeros_like(own), np.zeros_like(own)
        before[1:], after[:-1] = own[:-1], own[1:]
        features.append(np.hstack([own, before, after, np.ones((len(own), 1), np.float32)]))
    return fit(features, [int(x) for x in frame["label"]])


def score_quality(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_lines, n_bad (lines more likely bad), score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shared.value
        for batch in batches:
            scores, weights = [], []
            for text in batch.column(1):
                x, w = line_features(text.as_py())
                scores.append(x @ crf.weights)
                weights.append(w)
            good = crf.marginals(scores)[0]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(g) for g in good], pa.int64()),
                    pa.array([int((g < 0.5).sum()) for g in good], pa.int64()),
                    pa.array([float(np.average(g, weights=w)) for g, w in zip(good, weights)], pa.float64()),
                ],
                names=["id", "n_lines", "n_bad", "score"],
            )

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "id long, n_lines long, n_bad long, score double")
    return rows.withColumnRenamed("id", id_col)


def filter_quality(docs: DataFrame, model: Crf, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, with all their
    columns; scored where they lie, without a join."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        made = [line_features(t) for t in texts]
        return pd.Series(shared.value.score([x for x, _ in made], [w for _, w in made]))

    return docs.where(score(text_col) >= least)
