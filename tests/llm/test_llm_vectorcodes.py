import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm import vectorcodes as V

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        *(T.StructField(c, T.StringType()) for c in ("id", "x", "code", "error", "of", "salt", "vector")),
    ]
)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, *["noise"] * 7) for r in rows], SCHEMA).repartition(parts)


def brute(rows, entries, n_parts=4, n_rounds=4):
    """The definition, word for word, in Python integers."""
    kept = [(i, [math.floor(1024 * float(np.float32(c))) for c in v], y) for i, v, y in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], np.int32).tobytes(), r[2] is None, r[2] or 0))
    width = len(kept[0][1]) // n_parts
    cut = [[r[1][p * width : (p + 1) * width] for r in kept] for p in range(n_parts)]
    books = [part[:entries] for part in cut]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(n_rounds):
        for p in range(n_parts):
            groups = defaultdict(list)
            for part in cut[p]:
                groups[nearest(part, books[p])[1]].append(part)
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])]
    found = [[nearest(part, books[p]) for part in cut[p]] for p in range(n_parts)]
    out = [(r[0], r[2], "".join(f"{found[p][k][1]:02x}" for p in range(n_parts)), sum(found[p][k][0] for p in range(n_parts))) for k, r in enumerate(kept)]
    per_label = Counter()
    for _, y, _, e in out:
        per_label[y] += e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return Counter((i, code, e, per_label[y]) for i, y, code, e in out), sha


def run(spark, rows, entries, parts=3):
    coded, books = V.compress_vectors(frame(spark, rows, parts), entries=entries)
    assert coded.columns == ["vec_id", "label", "code", "error", "label_error"]
    return Counter(tuple(r) for r in coded.select("vec_id", F.lower(F.hex("code")), "error", "label_error").collect()), V.codebooks_sha256(books)


def vectors(n, seed=1, dim=8):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(9, dim))
    return [(int(i), [float(c) for c in (centre[i % 9] + 0.1 * rng.normal(size=dim)).astype(np.float32)], int(i) % 5 or None) for i in rng.permutation(n)]


ROWS = vectors(300)
ROWS += [(400 + i, [0.25] * 8, 7) for i in range(60)]  # one vector that many rows have
ROWS += [(1000, None, 1), (1001, [None] * 8, 1), (1002, [float("nan")] + [0.0] * 7, 2), (1003, [float("inf")] + [0.0] * 7, None), (1004, [-0.0001] * 8, None), (None, [0.5] * 8, 1)]


def test_equals_brute_force(llm_spark):
    assert run(llm_spark, ROWS, 40) == brute(ROWS, 40)


def test_fewer_rows_than_entries_ties_and_repeated_ids(llm_spark):
    rows = [(i % 7, [float(i % 2)] * 4 + [float(i % 3)] * 4, None) for i in range(30)] + [(None, [9.0] * 8, 3)] * 2
    assert run(llm_spark, rows, 256) == brute(rows, 256)


def test_length_that_parts_do_not_divide(llm_spark):
    rows = [(i, [float(i)] * 6, 1) for i in range(5)] + [(9, [1.0], 1), (10, [], 1)]
    got, _ = run(llm_spark, rows, 4)
    filled = [(i, v + [0.0, 0.0], y) for i, v, y in rows if len(v) == 6]
    assert got == brute(filled, 4)[0]


def test_empty_tables(llm_spark):
    for rows in ([], [(1, None, 1)], [(1, [], None), (2, [], None)]):
        coded, books = V.compress_vectors(frame(llm_spark, rows) if rows else llm_spark.createDataFrame([], SCHEMA))
        assert coded.count() == (2 if len(rows) == 2 else 0)
        assert len(books) == 4


def test_components_too_large_for_exact_distances_raise(llm_spark):
    with pytest.raises(Exception, match="not exact"):
        V.compress_vectors(frame(llm_spark, [(1, [1e9] * 4, 1)]))


def test_many_labels_join_salted(llm_spark, monkeypatch):
    monkeypatch.setattr(V, "BROADCAST_LABELS", 2)
    assert run(llm_spark, ROWS, 40) == brute(ROWS, 40)


@pytest.mark.parametrize("top", [3, 200, 1 << 20, (1 << 28) - 1])
@pytest.mark.parametrize("dim", [1, 2, 16])
def test_gnat_equals_full_search(top, dim):
    rng = np.random.default_rng(top + dim)
    for size in (1, 5, 40, 256, 700):
        entries = rng.integers(-top, top, (size, dim), endpoint=True)
        entries[rng.integers(0, size, size // 4)] = entries[0]  # repeated entries: ties
        queries = np.concatenate([rng.integers(-top, top, (300, dim), endpoint=True), entries, (entries[:-1] + entries[1:]) // 2])
        index, best = V.Gnat.build(entries).nearest(queries)
        full = ((queries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        assert (best == full.min(axis=1)).all()
        assert (index == full.argmin(axis=1)).all()


def test_gnat_leaves_most_subtrees_out_on_clusters(monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.integers(-(10**6), 10**6, (16, 16))
    entries = np.repeat(centres, 16, axis=0) + rng.integers(-50, 50, (256, 16))
    seen = []
    real = V._squared
    tree = V.Gnat.build(entries)
    monkeypatch.setattr(V, "_squared", lambda a, b, *c: seen.append(len(a) * len(b)) or real(a, b, *c))
    index, _ = tree.nearest(entries)
    assert (index == np.arange(256)).all()
    assert sum(seen) < 256 * 256 / 4
