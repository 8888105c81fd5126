"""Toxicity from a bidirectional gated recurrent network (operator 2).

A word enters as the sum of its own embedding (words that the sample often
has) and the scaled sum of its character n-grams' (hashed, word ends marked). A GRU reads each window of words in either direction, attention pools
the states and a logistic unit scores the window. Windows overlap by a
third and cover every word of every text; a document's score is that of its most toxic
window.

Trained in numpy on a bounded sample: only documents are labelled, so each
step learns from every sampled document's currently most toxic window. Scoring
runs inside the tasks: one projected input row per distinct word (kept in a
table of bounded size), windows sorted by length and advanced together.

Defined results: null, empty and blank texts are one window without words and
score what the bias says; repeated rows score alike; a null id is passed
through; an empty table gives no rows; without labelled rows of both kinds
every score is 0; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.labelled import collect_sorted, sample_labels, sample_texts

WINDOW, STRIDE = 64, 40
GRAMS = (3, 4, 5)
#: Longer words are read in pieces of so many characters.
LONG, PIECE = 80, 16
GRAM_ROWS, EMBED, HIDDEN, ATTEND = 1 << 14, 12, 8, 8
#: Words of a task's table of projected inputs; it is begun anew when full.
TABLE_WORDS = 200_000
#: Windows advanced together.
TOGETHER = 2048


def pieces_of(text: str | None) -> tuple[list[str], np.ndarray | None]:
    """The words of a text, with those over ``LONG`` characters (scripts without
    spaces, or words joined by punctuation) as overlapping pieces that hold
    every n-gram; and each one's word number (None if all are whole)."""
    words = (text or "").lower().split()
    if max(map(len, words), default=0) <= LONG:
        return words, None
    step = PIECE - max(GRAMS) + 1
    cut = [[w] if len(w) <= LONG else [w[a : a + PIECE] for a in range(0, len(w) - PIECE + step, step)] for w in words]
    return [p for ps in cut for p in ps], np.repeat(np.arange(len(words)), list(map(len, cut)))


def words_of(text: str | None) -> list[str]:
    return pieces_of(text)[0]


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of each word, ends marked: all words' one after
    another, and how many each has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    pad = max(GRAMS) - 3
    chars = np.frombuffer(("".join(f"^{w}${chr(0) * pad}" for w in words) + chr(0) * 2).encode("utf-32-le"), np.uint32)
    starts = np.cumsum(sizes + 2 + pad) - (sizes + 2 + pad)
    before = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)
    found = []
    for n in GRAMS:
        h = np.full(len(at), n, np.uint32)
        for i in range(n):
            h = (h ^ chars[at + i]) * np.uint32(16777619)
        found.append((h ^ (h >> np.uint32(15))) % np.uint32(GRAM_ROWS))
    return np.stack(found, axis=1).ravel().astype(np.int32), sizes * len(GRAMS)


def window_starts(n: int) -> range:
    """Starts of the overlapping windows over ``n`` words (one if none)."""
    return range(0, max(1, n - WINDOW + STRIDE), STRIDE)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``values`` summed by their index ``at`` in 0..n-1."""
    order = np.argsort(at, kind="stable")
    ids, first = np.unique(at[order], return_index=True)
    out = np.zeros((n, values.shape[1]), np.float32)
    out[ids] = np.add.reduceat(values[order], first, axis=0)
    return out


@dataclass
class Network:
    """Weights; names ending in 0 and 1 are of the two reading directions."""

    vocabulary: dict[str, int]  # word -> row of "words" (from 1; row 0 is any other word)
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, vocabulary: dict[str, int], seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        shapes = {"words": (len(vocabulary) + 1, EMBED), "grams": (GRAM_ROWS, EMBED), "att": (2 * HIDDEN, ATTEND), "att_v": (ATTEND,), "out": (2 * HIDDEN,)}
        for d in "01":
            shapes |= {"in" + d: (EMBED, 3 * HIDDEN), "hid" + d: (HIDDEN, 3 * HIDDEN)}
        p = {k: (rng.standard_normal(s) * (0.1 if k in ("words", "grams") else 1 / np.sqrt(s[0]))).astype(np.float32) for k, s in shapes.items()}
        p["words"][0] = 0
        p |= {"bias0": np.zeros(3 * HIDDEN, np.float32), "bias1": np.zeros(3 * HIDDEN, np.float32), "att_b": np.zeros(ATTEND, np.float32), "out_b": np.full(1, -2, np.float32)}
        return cls(vocabulary, p)

    def embed(self, word_rows: np.ndarray, grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Embedded words, a few thousand at a time."""
        x = self.p["words"][word_rows]
        ends = np.cumsum(sizes)
        for a in range(0, len(sizes), 10_000):
            n, start = sizes[a : a + 10_000], ends[a] - sizes[a]
            mine = self.p["grams"][grams[start : ends[a + len(n) - 1]]]
            x[a : a + len(n)] += np.add.reduceat(mine, np.cumsum(n) - n, axis=0) / np.sqrt(n)[:, None]
        return x

    def states(self, table: tuple[np.ndarray, np.ndarray], rows: np.ndarray, sizes: np.ndarray, keep: bool = False):
        """Hidden states (step, window, 2 x HIDDEN) of windows sorted by
        falling size. ``table``: each direction's projected inputs;
        ``rows``: (step, window) into it."""
        steps, n = rows.shape
        alive = np.searchsorted(-sizes, -np.arange(1, steps + 1), side="right")
        out = np.zeros((steps, n, 2 * HIDDEN), np.float32)
        trace: list[list[tuple]] = [[], []]
        for d, path in ((0, range(steps)), (1, range(steps - 1, -1, -1))):
            h = np.zeros((n, HIDDEN), np.float32)
            hid = self.p[f"hid{d}"]
            for t in path:
                if not (k := int(alive[t])):
                    continue
                x = table[d].take(rows[t, :k], axis=0)
                before = h[:k].copy() if keep else h[:k]
                past = before @ hid
                gates = x[:, : 2 * HIDDEN]
                gates += past[:, : 2 * HIDDEN]
                gates *= 0.5
                np.tanh(gates, out=gates)
                gates += 1
                gates *= 0.5
                z, r, u = gates[:, :HIDDEN], gates[:, HIDDEN:], past[:, 2 * HIDDEN :]
                c = np.tanh(x[:, 2 * HIDDEN :] + r * u)
                if keep:
                    trace[d].append((k, t, before, z, r, u, c))
                h[:k] += z * (c - before)
                out[t, :k, d * HIDDEN : (d + 1) * HIDDEN] = h[:k]
        return out, trace

    def pooled(self, out: np.ndarray, sizes: np.ndarray):
        """Attention over a window's steps: logit, and what training needs."""
        act = np.tanh(out @ self.p["att"] + self.p["att_b"])
        weight = act @ self.p["att_v"]
        weight[np.arange(len(out))[:, None] >= sizes] = -1e9
        weight = np.exp(weight - weight.max(axis=0))
        weight *= (sizes > 0) / weight.sum(axis=0)
        context = np.einsum("tn,tnh->nh", weight, out)
        return context @ self.p["out"] + self.p["out_b"][0], act, weight, context

    def tables(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple((x @ self.p[f"in{d}"] + self.p[f"bias{d}"]).astype(np.float32) for d in (0, 1))

    def logits(self, table: tuple[np.ndarray, np.ndarray], rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Logit of every window, in the order given."""
        result = np.empty(len(sizes), np.float32)
        order = np.argsort(-sizes, kind="stable")
        for a in range(0, len(order), TOGETHER):
            part = order[a : a + TOGETHER]
            s = sizes[part]
            r = np.ascontiguousarray(rows[part, : max(1, int(s[0]))].T)
            result[part] = self.pooled(self.states(table, r, s)[0], s)[0]
        return result

    def gradients(self, x: np.ndarray, rows: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the mean cross-entropy over windows sorted by falling
        size, and the gradient of the embedded words ``x``."""
        p, n = self.p, len(sizes)
        out, trace = self.states(self.tables(x), rows, sizes, keep=True)
        logit, act, weight, context = self.pooled(out, sizes)
        d_logit = (_sigmoid(logit) - y) / n
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("words", "grams")}
        g["out"], g["out_b"][0] = context.T @ d_logit, d_logit.sum()
        d_context = d_logit[:, None] * p["out"]
        d_out = weight[:, :, None] * d_context
        d_weight = np.einsum("tnh,nh->tn", out, d_context)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d_act = d_score[:, :, None] * p["att_v"] * (1 - act**2)
        g["att_v"], g["att_b"] = np.einsum("tn,tna->a", d_score, act), d_act.sum(axis=(0, 1))
        g["att"] = np.einsum("tnh,tna->ha", out, d_act)
        d_out += d_act @ p["att"].T
        at_rows, moved = [], []
        for d in (0, 1):
            hid, into = p[f"hid{d}"], p[f"in{d}"]
            d_h = np.zeros((n, HIDDEN), np.float32)
            for k, t, before, z, r, u, c in reversed(trace[d]):
                row = rows[t, :k]
                e = d_h[:k] + d_out[t, :k, d * HIDDEN : (d + 1) * HIDDEN]
                d_c = e * z * (1 - c**2)
                d_z = e * (c - before) * z * (1 - z)
                d_r = d_c * u * r * (1 - r)
                pre = np.concatenate([d_z, d_r, d_c], axis=1)
                back = np.concatenate([d_z, d_r, d_c * r], axis=1)
                g[f"hid{d}"] += before.T @ back
                g[f"bias{d}"] += pre.sum(axis=0)
                g[f"in{d}"] += x[row].T @ pre
                at_rows.append(row)
                moved.append(pre @ into.T)
                d_h[:k] = e * (1 - z) + back @ hid.T
        return g, _sums(np.concatenate(at_rows), np.concatenate(moved), len(x))


def _windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (window, step), sizes and owners of all windows of the texts,
    given as arrays of table rows."""
    owner, blocks, sizes = [], [], []
    for k, t in enumerate(texts):
        starts = np.array(window_starts(len(t)))
        padded = np.zeros(int(starts[-1]) + WINDOW, np.int64)
        padded[: len(t)] = t
        blocks.append(np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[starts])
        sizes.append(np.minimum(WINDOW, len(t) - starts))
        owner.append(np.full(len(starts), k))
    return np.concatenate(blocks), np.concatenate(sizes), np.concatenate(owner)


def _best(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Index of each owner's largest value (owners ascending)."""
    order = np.lexsort((-values, owner))
    return order[np.flatnonzero(np.r_[True, owner[order][1:] != owner[order][:-1]])]


def fit(texts: list[str], labels: list[int], epochs: int = 12, batch: int = 64, rate: float = 0.01, words_from: int = 3, seed: int = 7) -> Network | None:
    """Adam over each document's most toxic window; None without both labels."""
    if len(set(labels)) < 2:
        return None
    split = [words_of(t) for t in texts]
    counts = Counter(w for ws in split for w in set(ws))
    common = sorted((w for w, c in counts.items() if c >= words_from), key=lambda w: (-counts[w], w))[:20_000]
    net = Network.fresh({w: i + 1 for i, w in enumerate(common)}, seed)
    index = {w: i for i, w in enumerate(sorted(counts))}
    names = list(index) or ["-"]
    word_rows = np.array([net.vocabulary.get(w, 0) for w in names])
    grams, gram_sizes = grams_of(names)
    gram_first = np.cumsum(gram_sizes) - gram_sizes
    rows, sizes, owner = _windows([np.array([index[w] for w in ws], dtype=np.int64) for ws in split])
    y = np.array(labels, dtype=np.float32)
    first = np.searchsorted(owner, np.arange(len(texts)))
    count = np.bincount(owner, minlength=len(texts))
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.full_like(w, 1e-5 if k in ("words", "grams") else 0) for k, w in net.p.items()}
    step = 0
    for epoch in range(epochs):
        if epoch < epochs // 3:  # any window tells something of its document
            pick = first + rng.integers(0, 1 << 30, len(texts)) % count
        elif (epoch - epochs // 3) % 2 == 0:  # look again for the most toxic ones
            pick = _best(net.logits(net.tables(net.embed(word_rows, grams, gram_sizes)), rows, sizes), owner)
        for part in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // batch)):
            part = part[np.argsort(-sizes[pick[part]], kind="stable")]
            size, label = sizes[pick[part]], y[part]
            used, r = np.unique(rows[pick[part], : max(1, int(size[0]))], return_inverse=True)
            r = np.ascontiguousarray(r.reshape(len(part), -1).T)
            lens = gram_sizes[used]
            mine = grams[np.arange(int(lens.sum())) + np.repeat(gram_first[used] - (np.cumsum(lens) - lens), lens)]
            own = np.where(rng.random(len(used)) < 0.5, word_rows[used], 0)  # often only the spelling tells
            g, d_x = net.gradients(net.embed(own, mine, lens), r, size, label)
            step += 1
            pace = rate * min(1.0, step / 50) * (0.3 if epoch >= epochs - 3 else 1)
            for k in g:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                net.p[k] -= pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)
            # embeddings: only the rows of this batch's words move
            for k, at, grad in (
                ("grams", mine, np.repeat(d_x / np.sqrt(lens)[:, None], lens, axis=0)),
                ("words", own, d_x),
            ):
                ids, inverse = np.unique(at, return_inverse=True)
                total = _sums(inverse.ravel(), grad, len(ids))
                if k == "words" and ids[0] == 0:
                    ids, total = ids[1:], total[1:]
                v[k][ids] += total**2
                net.p[k][ids] -= 5 * pace * total / (np.sqrt(v[k][ids]) + 1e-6)
    return net


class Table(dict):
    """word -> row of its projected inputs, filled as words come up."""

    def __init__(self, net: Network) -> None:
        super().__init__()
        self.net, self.new = net, []
        self.rows = tuple(np.zeros((0, 3 * HIDDEN), np.float32) for _ in (0, 1))

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = len(self)
        return self[word]

    def project(self) -> tuple[np.ndarray, np.ndarray]:
        made = [self.rows]
        for a in range(0, len(self.new), TABLE_WORDS):
            new = self.new[a : a + TABLE_WORDS]
            made.append(self.net.tables(self.net.embed(np.array([self.net.vocabulary.get(w, 0) for w in new]), *grams_of(new))))
        if self.new:
            self.rows = tuple(np.concatenate(rows) for rows in zip(*made))
        self.new = []
        return self.rows


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", rows: tuple[int, int] = (2500, 1500), max_chars: int = 20_000, parts: int = 4, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> Network | None:
    """Fit on at most ``rows`` documents labelled 0 and 1 of the learning
    folds, each at most ``max_chars`` long."""
    frame = collect_sorted(sample_texts(docs, sample_labels(labels, label_col, rows, parts, held_out, id_col), max_chars, id_col, text_col), "id", "text")
    return fit(list(frame["text"]), [int(x) for x in frame["label"]])


def score_toxicity(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_windows, worst (first word of its most toxic
    window, or the long word that this begins in), score."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table = Table(model) if model else None
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a in range(0, len(ids), 256):
                part, numbers = zip(*(pieces_of(t.as_py()) for t in texts[a : a + 256]))
                if model is None:
                    n = [len(window_starts(len(w))) for w in part]
                    best, score = np.zeros(len(part), int), np.zeros(len(part))
                else:
                    if len(table) > TABLE_WORDS:
                        table = Table(model)
                    mapped = [np.fromiter(map(table.__getitem__, w), np.int64, len(w)) for w in part]
                    if not len(table):
                        table["-"]  # a table is never without a row
                    rows, sizes, owner = _windows(mapped)
                    value = model.logits(table.project(), rows, sizes)
                    at = _best(value, owner)
                    n = np.bincount(owner, minlength=len(part))
                    best = (at - np.searchsorted(owner, np.arange(len(part)))) * STRIDE
                    best = [int(b if w is None else w[b]) for b, w in zip(best, numbers)]
                    score = 1 / (1 + np.exp(-value[at].astype(np.float64)))
                columns = [pa.array(n, pa.int64()), pa.array(best, pa.int64()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays([ids[a : a + 256], *columns], names=["id", "n_windows", "worst", "score"])

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "id long, n_windows long, worst long, score double")
    return rows.withColumnRenamed("id", id_col)
