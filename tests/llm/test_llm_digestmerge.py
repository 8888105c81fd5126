import hashlib
import re
from collections import Counter, defaultdict

import pytest
from llm_docs import make_docs, words

from ledgerflow.llm import digestmerge


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), i is None, i))
    out = Counter()
    for bare, members in groups.items():
        sha = hashlib.sha256(bare.encode()).hexdigest()
        keeper, *rest = sorted(members, key=lambda m: (m[0], m[1], m[2] or 0))
        out[keeper[2], keeper[2], len(members), True, sha] += 1
        for m in rest:
            out[m[2], keeper[2], len(members), False, sha] += 1
    return out


def run(spark, rows, parts=5, **how):
    found = digestmerge.exact_duplicates(make_docs(spark, rows, parts), **how)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return Counter(tuple(r) for r in found.collect())


HOT = "one text that a third of all rows have"
ROWS = [(i, HOT if i % 3 == 0 else " ".join(words(i, 12))) for i in range(1, 240)]
ROWS += [(1000 + i, HOT.replace(" ", " \n\t"[i % 3] * (1 + i % 4))) for i in range(60)]
ROWS += [(2001, None), (2002, ""), (2003, " \t\n\x0b\x0c\r"), (2004, " "), (2005, " "), (2006, "ＡB"), (2007, "Ａ B"), (2008, "ab"), (2009, "AB")]
ROWS += [(2010, "x" * 300_000), (2011, "x " * 300_000), (2012, "x" * 299_999)]


@pytest.mark.parametrize(("slots", "width"), [(1, 3), (2, 1), (16, 2), (32, 3)])
def test_equals_brute_force(llm_spark, slots, width):
    assert run(llm_spark, ROWS, slots=slots, width=width) == brute(ROWS)


def test_ties_repeated_rows_and_null_ids(llm_spark):
    rows = [(5, "a b"), (3, "a b"), (3, "a b"), (3, "a b"), (None, "a b"), (4, "a  b"), (None, "c d"), (None, "c d"), (9, "c d"), (None, "alone")]
    assert run(llm_spark, rows) == brute(rows)
    assert run(llm_spark, rows, parts=1) == brute(rows)


def test_colliding_order_hashes_do_not_merge(llm_spark):
    """The run order is only an order: entries that agree in it but not in
    their SHA-256 stay apart at every level."""
    rows = digestmerge.digests(make_docs(llm_spark, [(1, "a"), (2, "b"), (3, "a"), (4, "b"), (5, "c")], 2), 4)
    clash = rows.withColumn("h", rows.h * 0 + 7)
    last = digestmerge.levels(clash, 4)[-1].collect()
    assert sorted((r.id, r.n) for r in last) == [(1, 2), (2, 2), (5, 1)]


def test_no_task_reads_a_group_whole(llm_spark):
    """Of a group that every row belongs to, a slot has one entry a level."""
    docs = make_docs(llm_spark, [(i, HOT) for i in range(800)], 16)
    tree = digestmerge.levels(digestmerge.digests(docs, 16), 16, 2)
    assert [t.count() for t in tree] == [16, 4, 1]
    assert tree[-1].first().n == 800


def test_runs_across_batches(llm_spark):
    llm_spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert run(llm_spark, ROWS[:120], slots=4) == brute(ROWS[:120])
    finally:
        llm_spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_text_ids(llm_spark):
    docs = llm_spark.createDataFrame([("b", "x y"), ("a", "xy "), ("c", "z")], "doc_id string, text string")
    got = {r.doc_id: (r.keep_id, r.kept) for r in digestmerge.exact_duplicates(docs).collect()}
    assert got == {"a": ("a", True), "b": ("a", False), "c": ("c", True)}


def test_empty_table(empty):
    assert digestmerge.exact_duplicates(empty).count() == 0
