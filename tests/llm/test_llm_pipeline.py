import importlib
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the given tables")


def test_stages_keep_columns_and_take_effect(llm_spark):
    import corpus_pipeline as P

    from ledgerflow.llm.common import shared_table

    assert [n for n, _ in P.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "packing"]
    docs = llm_spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in P.STAGES[:-1]:
        out = shared_table(stage(llm_spark, docs, SF), name)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert 0 < out.count() <= docs.count()
        docs = out
    assert docs.count() < before
    ids = docs.select("doc_id").distinct().count()
    packed = P.STAGES[-1][1](llm_spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == ids


def test_run_equals_its_stages_one_by_one(llm_spark):
    """A brute-force line dedup, linking and containment over what the quality
    stage keeps leaves the documents that run() packs."""
    import corpus_pipeline as P
    from test_llm_decontaminate import shingles as words_in
    from test_llm_linededup import key
    from test_llm_ngramjoin import brute

    docs = llm_spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in P.quality_stage(llm_spark, docs, SF).collect())
    holders = {}
    for i, t in rows:
        for line in t.split("\n"):
            holders.setdefault(key(line), set()).add(i)
    kept = []
    for i, t in rows:
        lines = [x for x in t.split("\n") if len(key(x)) < 10 or min(holders[key(x)]) == i]
        if lines:
            kept.append((i, "\n".join(lines)))
    first = {i for i, n, c in brute(kept) if n == 0 or i == c}
    kept = [(i, t) for i, t in kept if i in first]
    items = [words_in(r.text) for r in llm_spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i, t in kept if not any(x and 100 * len(x & words_in(t)) >= 75 * len(x) for x in items)}
    assert {r.doc_id for r in P.run(llm_spark, SF).select("doc_id").collect()} == clean


def test_edge_rows_of_every_stage(llm_spark):
    """Null, empty, blank, long and repeated texts, null and repeated ids, and
    columns that the stages do not know, alone and as an empty table."""
    import corpus_pipeline as P

    labelled = llm_spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1")
    t = [r.text for r in llm_spark.read.parquet(f"{SF}/documents.parquet").join(labelled, "doc_id").orderBy("doc_id").limit(3).collect()]
    item = llm_spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(None, None), (1, None), (2, ""), (3, " \t\n"), (4, t[0]), (4, t[0]), (5, t[0]), (None, t[1]), (7, t[2] * 40), (8, "ok"), (9, f"before {item} behind")]
    docs = llm_spark.createDataFrame([(i, x, "en", "web", len(x or ""), "a", "b", "c") for i, x in rows], "doc_id long, text string, lang string, source string, n_chars long, row string, label string, key string").repartition(3)
    gone = {"quality": [], "line_dedup": ["5"], "near_duplicates": ["4", "5"], "decontamination": ["9"]}
    for name, stage in P.STAGES[:-1]:
        out = stage(llm_spark, docs, SF)
        assert out.columns == P.COLUMNS
        kept = sorted(str(r.doc_id) for r in out.collect())
        want = sorted(str(i) for i, _ in rows)
        for i in gone[name]:
            want.remove(i)
        assert kept == want, name
        assert stage(llm_spark, docs.limit(0), SF).count() == 0
    packed = P.STAGES[-1][1](llm_spark, docs, SF).collect()
    assert sorted({str(r.doc_id) for r in packed}) == sorted({str(i) for i, _ in rows})
    assert sum(r.piece == 0 for r in packed) == len(rows)
    assert P.STAGES[-1][1](llm_spark, docs.limit(0), SF).count() == 0


def test_every_operator_has_a_query():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


def test_the_rest_works_without_this_part(tmp_path):
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'ledgerflow.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(k.startswith('op') for k in e.queries()) and 'pipeline' not in e.queries()\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
