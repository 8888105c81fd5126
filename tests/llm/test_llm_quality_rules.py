import random
import re
from collections import Counter

import numpy as np
from llm_docs import make_docs, words

from ledgerflow.llm import quality_rules


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    counts = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {p for k in range(len(w) - 7) if counts[tuple(w[k : k + 8])] > 1 for p in range(k, k + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
    return (*n, n[0] < 20 or 100 * n[4] > 30 * n[0])


BASE = " ".join(words(1, 60))
TEXTS = ["", None, " \t\n", "one", "a b\na b\n\n \n \na  b", "é三😀 #*$%&|<>", BASE, BASE + "\n" + BASE, "w " * 40, BASE + " tail " + BASE[:120], " ".join(words(2, 30000)), "x y z " * 20000, "a b c d e f g h i a b c d e f g h", "q " * 8, "q " * 9]


def test_base_columns_equal_brute_force(llm_spark):
    docs = make_docs(llm_spark, [(i, t, "en", None) for i, t in enumerate(TEXTS)] + [(None, BASE, None, "s"), (6, BASE, "en", None)])
    rows = quality_rules.quality_rules(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        want = brute(BASE if r.doc_id is None else TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, r.doc_id
        assert not (r.kept and r.base_failed)
        assert r.kept == (not r.base_failed)  # too few rows for any estimate


def mixed(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        junk = i % 8 == 0
        w = words(seed * 10**6 + i, rng.randrange(60, 400))
        rows.append((i, " ".join(x + "###%%%" for x in w) if junk else ".\n".join(" ".join(w[k : k + 12]) for k in range(0, len(w), 12)), rng.choice(["en", None]), "hot" if i % 3 else f"s{i % 4}"))
    return rows


def test_outliers_are_rejected_and_the_rest_kept(llm_spark):
    rows = mixed(700, 3)
    got = {r.doc_id: r for r in quality_rules.quality_rules(make_docs(llm_spark, rows)).collect()}
    assert [i for i in got if got[i].kept == (i % 8 == 0)] == []


def test_estimates_equal_numpy(llm_spark):
    """The distance after the last step, from the rows that it was made of."""
    rows = mixed(400, 5)
    stats = quality_rules.text_statistics(make_docs(llm_spark, [(i, t, "en", "s") for i, t, *_ in rows]))
    frame = stats.withColumns(quality_rules._vector()).selectExpr("'g' AS g", *quality_rules.VECTOR).cache()
    names = list(quality_rules.VECTOR)
    x = np.array([[r[a] for a in names] for r in frame.collect()])
    from pyspark.sql import functions as F

    near = F.col("log_words") > 4.5
    got = quality_rules._distance(frame, quality_rules._estimates(frame, near, 0.9), True)
    picked = x[x[:, 0] > 4.5]
    floor = np.array(list(quality_rules.VECTOR.values())) ** 2
    cov = np.cov(picked.T, bias=True) / 0.9 + np.diag(floor)
    d = x - picked.mean(axis=0)
    want = np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)
    assert np.allclose(sorted(r.d2 for r in got.collect()), sorted(want))


def test_no_python_on_the_main_path(llm_spark):
    plan = quality_rules.quality_rules(make_docs(llm_spark, mixed(90, 1)))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty_table(empty):
    assert quality_rules.quality_rules(empty).count() == 0
