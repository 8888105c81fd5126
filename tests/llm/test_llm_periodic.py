import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from llm_docs import make_docs, words
from pyspark.sql import functions as F

from ledgerflow.llm import periodic, queries


def brute(w):
    """All maximal stretches under their smallest period, by comparing words."""
    out = {}
    for q in range(1, len(w) // 3 + 1):
        j = 0
        while j + q < len(w):
            if w[j] != w[j + q]:
                j += 1
                continue
            s = j
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - s >= max(24, 3 * q):
                out.setdefault((s, j + q), q)
    return sorted((s, e, q) for (s, e), q in out.items())


def nested(rng, n):
    """Words with periodic stretches, some of whose periods are periodic too."""
    w = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 20, 1000])) for _ in range(n)]
    for _ in range(rng.randint(0, 4) if n else 0):
        a = rng.randrange(n)
        b = min(n, a + rng.choice([30, 60, 100, 300]))
        p = rng.randint(1, max(1, (b - a) // 3))
        block = w[a : a + p]
        if rng.random() < 0.5 and p > 6:
            small = rng.randint(1, p // 3)
            block = [block[i % small] for i in range(p - 1)] + [block[-1]]
        w[a:b] = [block[i % len(block)] for i in range(b - a)]
        if rng.random() < 0.3:
            w[rng.randrange(n)] = b"x"
    return w


@pytest.mark.parametrize("seed", range(6))
def test_equals_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        texts = [nested(rng, rng.choice([0, 1, 5, 23, 24, 30, 60, 120, 300, 700])) for _ in range(rng.randint(1, 8))]
        for w, got in zip(texts, periodic.runs_of(texts)):
            assert sorted(map(tuple, got.tolist())) == brute(w)


@pytest.mark.parametrize("q", [*range(1, 20), 31, 32, 33, 63, 64, 65, 100, 127, 128, 129])
def test_every_period_at_its_least_length(q):
    """A run of exactly three periods between other words, at all scales."""
    for length in (max(24, 3 * q) - 1, max(24, 3 * q)):
        block = words(q, q)
        w = [x.encode() for x in [*words(900, 7), *(block[i % q] for i in range(length)), *words(901, 9)]]
        assert [tuple(r) for r in periodic.runs_of([w])[0].tolist()] == brute(w)


def test_selection_depends_on_the_context_alone():
    rng = np.random.default_rng(1)
    part = rng.integers(0, 3, 400)
    ids = np.concatenate([[-1], part, [-2], part, [-3]])
    h = periodic.mix(ids.astype(np.uint64))
    for k in (1, 2, 4):
        h = periodic._pair(h[:-k], h[k:])
    at = periodic.selected(h, 8, periodic._direct(ids))
    first = at[(at >= 1) & (at <= 1 + 400 - 16)]
    assert (np.isin(first + 401, at)).all()
    assert np.diff(first).max() <= 8 + 24  # no gap without a small period


def run(spark, rows, parts=3):
    docs = make_docs(spark, rows, parts).withColumn("runs", F.lit("clash"))
    found = periodic.periodic_runs(docs)
    assert set(found.columns) == {*docs.columns, "n_words", "collapsed"} - {"text"}
    return found.collect()


def test_edge_rows(llm_spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (3, "a " * 24), (None, "a " * 23), (5, "x y z " * 30), (6, "a\x1cb " * 30)]
    got = {(r.doc_id, r.n_words): r for r in run(llm_spark, rows)}
    assert [(k, [tuple(x) for x in r.runs], r.collapsed) for k, r in sorted(got.items(), key=str)] == [
        ((1, 0), [], ""), ((2, 0), [], ""), ((3, 0), [], ""), ((3, 24), [(0, 24, 1)], "a"), ((5, 30), [(0, 30, 1)], "x y z"), ((6, 30), [(0, 30, 1)], "a\x1cb"),
        ((None, 23), [], " ".join("a" * 23)),
    ]


def test_long_texts_and_chunks(llm_spark, monkeypatch):
    monkeypatch.setattr(periodic, "CHUNK_BYTES", 5_000)
    rows = [(i, " ".join(words(i, 200))) for i in range(60)] + [(100, "w " * 300_000), (101, " ".join(words(1, 5_000) * 4))]
    got = {r.doc_id: r for r in run(llm_spark, rows)}
    assert [tuple(x) for x in got[100].runs] == [(0, 300_000, 1)] and got[100].collapsed == "w"
    assert [tuple(x) for x in got[101].runs] == [(0, 20_000, 5_000)] and got[101].collapsed == " ".join(words(1, 5_000))


def test_time_grows_with_the_text_not_its_square():
    took = []
    for n in (40_000, 160_000):
        w = [x.encode() for x in words(3, n // 4)] * 4
        w[n // 2 : n // 2 + n // 8] = [b"%d" % (i % 3) for i in range(n // 8)]
        began = time.process_time()
        periodic.runs_of([w])
        took.append(time.process_time() - began)
    assert took[1] < 10 * took[0] + 1


def planted(i, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(i).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (k - a) % p] for k in range(a, n)]


def test_query_equals_its_definition(llm_spark, tmp_path):
    rows = [(i, " ".join(words(i, 5 + 7 * i % 300))) for i in range(150)] + [(150, None), (151, "a b " * 40), (158, ""), (None, "a " * 30)]
    make_docs(llm_spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_periodic_runs(llm_spark, str(tmp_path)).collect()}
    for i, text in rows:
        w = planted(i, text) if i is not None else (text or "").split()
        found = brute(w)
        best = min(found, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
        told = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
        gone = {k for s, e, q in found for k in range(s + q, e)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        head = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
        assert got[i] == (len(found), *head, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()), i


def test_empty_table(empty):
    assert periodic.periodic_runs(empty).count() == 0
