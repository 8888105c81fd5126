import hashlib
import re
from collections import defaultdict

from llm_docs import make_docs
from pyspark.sql import functions as F

from ledgerflow.llm import linededup


def key(line):
    return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, least=10):
    docs = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            docs[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or len(docs[key(x)]) < 2 or min(docs[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def run(spark, rows, parts=5):
    docs = make_docs(spark, rows, parts)
    kept = linededup.apply_keep(docs, linededup.line_keep_bitmaps(docs))
    assert kept.columns == [*docs.columns, "n_lines", "n_dropped"]
    return sorted(tuple(r) for r in kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect())


HOT = "a line that very many documents share"
ROWS = [(i, f"{HOT.upper() if i % 3 else HOT}  \nown line number {i} is here\n{HOT}\nshort") for i in range(300)]
ROWS += [(301, None), (302, ""), (303, "\n\n"), (304, " \t\n" + HOT), (305, "ÉÉÉÉÉÉÉÉÉ"), (306, "ÉÉÉÉÉÉÉÉÉ"), (307, "ÉÉÉÉÉÉÉÉÉÉ"), (308, "ÉÉÉÉÉÉÉÉÉÉ")]
ROWS += [(309, "\n".join(f"line {k} of a very long text" for k in range(20000)))]


def test_equals_brute_force(llm_spark):
    assert run(llm_spark, ROWS) == brute(ROWS)


def test_rows_that_repeat_an_id_are_one_document(llm_spark):
    rows = [(1, "the same long line"), (1, "the same long line"), (1, "the same long line\nand another one"), (2, "and another one")]
    assert run(llm_spark, rows) == brute(rows)


def test_null_id_is_the_smallest(llm_spark):
    docs = make_docs(llm_spark, [(None, "the same long line"), (1, "the same long line")])
    got = linededup.line_keep_bitmaps(docs).collect()
    assert sorted((str(r.doc_id), r.n_dropped) for r in got) == [("1", 1), ("None", 0)]


def test_runs_across_batches_and_partitions(llm_spark, monkeypatch):
    llm_spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert run(llm_spark, ROWS[:60]) == brute(ROWS[:60])
    finally:
        llm_spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_bitmap_round_trip(llm_spark):
    got = {r.doc_id: r for r in linededup.line_keep_bitmaps(make_docs(llm_spark, ROWS[:3])).collect()}
    assert linededup.unpack_bitmap(got[1].keep_bitmap, got[1].n_lines).tolist() == [False, True, False, True]


def test_empty_table(empty):
    assert linededup.apply_keep(empty, linededup.line_keep_bitmaps(empty)).count() == 0
