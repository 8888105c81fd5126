import itertools
import zlib

import numpy as np
import pytest
from llm_docs import make_docs, words
from pyspark.sql import functions as F

from ledgerflow.llm import crf, labelled, toxicity


def held_out(i, parts, rest):
    return zlib.crc32(str(i).encode()) % parts == rest


def auc(scores, labels):
    good = [s for s, y in zip(scores, labels) if y]
    bad = [s for s, y in zip(scores, labels) if not y]
    return np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])


# -- CRF ------------------------------------------------------------------


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    model = crf.Crf(np.zeros(crf.WIDTH), rng.normal(size=(2, 2)))
    chains = [rng.normal(size=n) for n in (4, 1, 6, 3, 4)]
    good, total, edges = model.marginals(chains)
    for emit, marginal, z, e in zip(chains, good, total, edges):
        paths = list(itertools.product((0, 1), repeat=len(emit)))
        score = [sum(x * y for x, y in zip(emit, p)) + sum(model.transitions[a, b] for a, b in zip(p, p[1:])) for p in paths]
        weight = np.exp(score)
        assert np.isclose(z, np.log(weight.sum()))
        weight /= weight.sum()
        assert np.allclose(marginal, [sum(w for w, p in zip(weight, paths) if p[t]) for t in range(len(emit))])
        for a, b in itertools.product((0, 1), repeat=2):
            assert np.isclose(e[a, b], sum(w * sum(q == (a, b) for q in zip(p, p[1:])) for w, p in zip(weight, paths)))


def quality_rows(n):
    rows, labels = [], []
    for i in range(n):
        w = words(i, 60)
        bad = i % 4 == 0
        lines = [" ".join(w[k : k + 10]) for k in range(0, 60, 10)]
        rows.append((i, "\n".join(f"{x.replace(' ', '### ')}%%%" if bad and k else x.capitalize() + "." for k, x in enumerate(lines))))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_quality_of_held_out_documents(llm_spark):
    rows, labels = quality_rows(240)
    docs, table = make_docs(llm_spark, rows), llm_spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = crf.train(docs, table)
    got = {r.doc_id: r for r in crf.score_quality(docs, model).collect()}
    out = [(got[i].score, y) for i, y, _ in labels if held_out(i, 5, 0)]
    assert len(out) > 20 and auc(*zip(*out)) > 0.98
    kept = crf.filter_quality(docs, model, 0.3)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if got[i].score >= 0.3}


def test_quality_edge_rows(llm_spark, empty):
    rows, labels = quality_rows(80)
    table = llm_spark.createDataFrame(labels + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    model = crf.train(make_docs(llm_spark, rows), table)
    odd = [(1, None), (2, ""), (3, "\n\n\n"), (4, "one line"), (4, "one line"), (None, "one line"), (5, "a line of words\n" * 30000)]
    got = crf.score_quality(make_docs(llm_spark, odd), model).collect()
    assert len(got) == len(odd) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1].score == by[2].score and by[1].n_lines == 1 and by[5].n_lines == 30001
    assert len({round(r.score, 12) for r in got if r.doc_id in (4, None)}) == 1
    assert crf.score_quality(empty, model).count() == 0
    unlearnt = crf.train(make_docs(llm_spark, rows), table.where("quality = 1"))
    assert [r.score for r in crf.score_quality(make_docs(llm_spark, odd), unlearnt).collect()] == pytest.approx([0.5] * len(odd))


def test_learning_never_sees_held_out_labels_and_is_bounded(llm_spark):
    labels = llm_spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    drawn = labelled.sample_labels(labels, "quality", (30, 20), 5, 0).collect()
    assert not any(held_out(r.id, 5, 0) for r in drawn)
    assert [sum(r.label == y for r in drawn) for y in (0, 1)] == [30, 20]
    rest = llm_spark.range(50).select(labelled.remainder("id", 5).alias("r"), "id").collect()
    assert all((r.r == 0) == held_out(r.id, 5, 0) for r in rest)


# -- toxicity -------------------------------------------------------------

BAD = ["vilezor", "vilekan", "vilemut", "scumbo", "zagdirt"]


def toxic_rows(n, seed=0):
    rows, labels = [], []
    for i in range(n):
        w = words(seed * 10**6 + i, 20 + 17 * (i % 15))
        y = int(i % 5 == 0)
        for k in range(y * (2 + len(w) // 40)):
            w[(7 * k + 3 * i) % len(w)] = BAD[(i + k) % len(BAD)]
        rows.append((i, " ".join(w)))
        labels.append((i, 1, y))
    return rows, labels


def test_gradients_equal_differences():
    net = toxicity.Network.fresh({}, 1)
    x = np.random.default_rng(0).standard_normal((5, toxicity.EMBED)).astype(np.float32)
    rows, sizes, y = np.array([[0, 3, 1], [1, 4, 1], [2, 0, 0]]), np.array([3, 2, 1]), np.array([1, 0, 1], np.float32)

    def loss():
        logit = net.pooled(net.states(net.tables(x), rows, sizes)[0], sizes)[0].astype(float)
        return float(np.mean(np.log1p(np.exp(logit)) - y * logit))

    grads, d_x = net.gradients(x, rows, sizes, y)
    for array, grad in [*((net.p[k], g) for k, g in grads.items()), (x, d_x)]:
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        old = array[at]
        array[at] = old + 1e-2
        up = loss()
        array[at] = old - 1e-2
        down = loss()
        array[at] = old
        assert np.isclose((up - down) / 2e-2, grad[at], rtol=0.02, atol=1e-5)


def test_windows_overlap_and_cover_every_word():
    for n in [0, 1, 63, 64, 65, 104, 105, 1000]:
        starts = list(toxicity.window_starts(n))
        covered = {k for s in starts for k in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n)) and starts[0] == 0
        assert all(b - a < toxicity.WINDOW for a, b in zip(starts, starts[1:]))


@pytest.fixture(scope="module")
def net():
    rows, labels = toxic_rows(500)
    return toxicity.fit([t for _, t in rows], [y for *_, y in labels])


def test_toxicity_of_other_documents(llm_spark, net):
    rows, labels = toxic_rows(200, seed=9)
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(make_docs(llm_spark, rows), net).collect()}
    y = [y for *_, y in labels]
    assert auc([got[i] for i, _ in rows], y) > 0.95


def test_one_bad_passage_in_a_very_long_text_counts(llm_spark, net):
    calm = words(5, 20000)
    loud = calm[:15000] + ["vilezor", "scumbo", "zagdirt", "vilekan"] + calm[15000:]
    got = {r.doc_id: r for r in toxicity.score_toxicity(make_docs(llm_spark, [(1, " ".join(calm)), (2, " ".join(loud))]), net).collect()}
    assert got[2].score > got[1].score and abs(got[2].worst - 15000) < toxicity.WINDOW


def test_every_character_of_a_long_word_is_read():
    for n in (81, 92, 93, 100, 1000):
        word = "".join(chr(0x4E00 + i) for i in range(n))
        pieces, numbers = toxicity.pieces_of(f"a {word} b")
        assert pieces[0] == "a" and pieces[-1] == "b" and numbers.tolist() == [0] + [1] * (len(pieces) - 2) + [2]
        grams = {p[k : k + 5] for p in pieces for k in range(len(p) - 4)}
        assert grams == {word[k : k + 5] for k in range(n - 4)}
    assert toxicity.pieces_of("x " + "y" * 80) == (["x", "y" * 80], None)


def test_a_bad_passage_inside_a_text_without_spaces_counts(llm_spark, net):
    calm = words(6, 2000)
    loud = calm[:1000] + ["vilezor", "scumbo", "zagdirt", "vilekan"] * 4 + calm[1000:]
    rows = [(1, "ab cd " + "_".join(calm)), (2, "ab cd " + "_".join(loud) + " ef"), (3, " ".join([*calm[:500], "_".join(loud)]))]
    got = {r.doc_id: r for r in toxicity.score_toxicity(make_docs(llm_spark, rows), net).collect()}
    assert got[2].score > got[1].score and got[2].worst == 2 and got[3].worst == 500
    assert got[1].n_windows > 20


def test_small_tables_and_chunks_give_the_same(net, monkeypatch):
    texts = [t for _, t in toxic_rows(40, seed=4)[0]]
    table = toxicity.Table(net)
    rows, sizes, owner = toxicity._windows([np.array([table[w] for w in toxicity.words_of(t)]) for t in texts])
    whole = net.logits(table.project(), rows, sizes)
    monkeypatch.setattr(toxicity, "TOGETHER", 3)
    assert np.allclose(whole, net.logits(table.project(), rows, sizes), atol=1e-4)


def test_toxicity_edge_rows(llm_spark, empty, net):
    odd = [(1, None), (2, ""), (3, " \n"), (4, "fine words"), (4, "fine words"), (None, "fine words"), (5, "w" * 100000)]
    got = toxicity.score_toxicity(make_docs(llm_spark, odd), net).collect()
    assert len(got) == len(odd) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert {r.score for r in toxicity.score_toxicity(make_docs(llm_spark, odd), None).collect()} == {0.0}
    assert toxicity.score_toxicity(empty, net).count() == 0


def test_training_reads_labels_of_learning_folds_only(llm_spark):
    rows, labels = toxic_rows(60)
    docs = make_docs(llm_spark, rows)
    table = llm_spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    flipped = table.withColumn("toxic", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, table), toxicity.train(docs, flipped)
    assert all(np.array_equal(a.p[k], b.p[k]) for k in a.p)
