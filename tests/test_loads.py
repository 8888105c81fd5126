"""Loads that follow each other: duplicates, publication, history, job graph,
change sets and the incremental schedule."""

import datetime as dt
import threading
from collections import Counter
from decimal import Decimal

import pytest
from fixtures import purchase_rows, to_csv, write_fixtures
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators import rule_duplicated, rule_expr, validate
from ledgerflow.operators.changes import change_set
from ledgerflow.plans import claims, jobs
from ledgerflow.plans.buckets import BucketTable
from ledgerflow.plans.graph import Step, run_steps
from ledgerflow.plans.history import RunHistory
from ledgerflow.plans.publish import Publication
from ledgerflow.plans.seen import SeenRows
from ledgerflow.plans.increment import refresh_schedule

ROWS = "k long, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, x) for x in t))


# ------------------------------------------------------ duplicates across loads


def load(spark, seen, name, data, record=True):
    v = validate(spark.createDataFrame(data, ROWS), [rule_duplicated(), rule_expr(F.col("v") == "bad", "bad value")], seen=seen, load=name)
    out = rows(v.accepted), rows(v.rejected)
    if record:
        v.record()
    return out


def test_loads_that_overlap_equal_one_load(spark, tmp_path):
    loads = [
        [(1, "a"), (2, "b"), (2, "b"), (3, None), (None, "3")],
        [(1, "a"), (4, "d"), (2, "b"), (None, "3"), (9, "bad")],
        [(1, "a"), (4, "d"), (5, "e"), (3, None)],
    ]
    seen = SeenRows(spark, str(tmp_path / "seen"), ["k", "v"], n_buckets=8)
    got = [load(spark, seen, f"load{i}", data) for i, data in enumerate(loads)]
    one = validate(spark.createDataFrame(sum(loads, []), ROWS), [rule_duplicated(), rule_expr(F.col("v") == "bad", "bad value")])
    assert sorted(sum((a for a, _ in got), []), key=str) == sorted(rows(one.accepted), key=str)
    assert sorted(sum((r for _, r in got), []), key=str) == sorted(rows(one.rejected), key=str)


def test_state_survives_a_restart_and_a_repeated_load_is_no_duplicate(spark, tmp_path):
    path = str(tmp_path / "seen")
    first = load(spark, SeenRows(spark, path, ["k", "v"]), "a", [(1, "x")])
    again = load(spark, SeenRows(spark, path, ["k", "v"]), "a", [(1, "x")])  # it died before its end was noted
    assert first == again == ([(1, "x")], [])
    assert load(spark, SeenRows(spark, path, ["k", "v"]), "b", [(1, "x"), (2, "y")]) == ([(2, "y")], [(1, "x", "duplicated")])
    assert load(spark, SeenRows(spark, path, ["k", "v"]), "c", [(1, "x")]) == ([], [])


def test_a_small_load_reads_few_buckets_and_compaction_changes_nothing(spark, tmp_path):
    seen = SeenRows(spark, str(tmp_path / "seen"), ["k", "v"], n_buckets=64)
    load(spark, seen, "big", [(i, "x") for i in range(2000)])
    load(spark, seen, "more", [(i, "y") for i in range(50)])
    v = validate(spark.createDataFrame([(7, "x")], ROWS), [rule_duplicated()], seen=seen, load="small")
    files = [f for f in v.annotated.inputFiles() if "/load=" in f]
    assert {f.split("/bucket=")[1].split("/")[0] for f in files} <= {f"{b}" for b in range(64)} and len({f.split("/bucket=")[1].split("/")[0] for f in files}) == 1
    assert rows(v.rejected) == [(7, "x", "duplicated")] and rows(v.accepted) == []
    assert seen.compact() == "base-1" and seen.loads() == ["base-1"]
    assert load(spark, seen, "later", [(7, "x"), (7, "y"), (7, "z")]) == ([(7, "z")], [(7, "x", "duplicated"), (7, "y", "duplicated")])
    assert seen.compact() == "base-2"
    assert load(spark, seen, "last", [(7, "x"), (7, "z")]) == ([], [(7, "z", "duplicated")])
    with pytest.raises(ValueError, match="compacted"):
        load(spark, seen, "big", [(1, "x")])


def test_stream_finds_duplicates_across_batches_and_restarts(spark, tmp_path):
    from ledgerflow.streaming import start_quarantine_stream

    src = write_fixtures(tmp_path / "input")
    landing, out = tmp_path / "landing", tmp_path / "out"
    landing.mkdir()
    postal = jobs.compute_postal_codes(spark, str(src / "postal_codes.csv"))
    for name, part in (("a", purchase_rows()), ("b", purchase_rows()[:20])):
        (landing / f"{name}.csv").write_text(to_csv(part), encoding="utf-8")
        q = start_quarantine_stream(spark, str(landing), postal, str(out))
        q.awaitTermination(300)
        assert q.exception() is None
    both = spark.read.parquet(str(out / "staging"))
    assert both.count() == 25 and both.drop("batch").distinct().count() == 25


# ------------------------------------------------------------------ publication


@pytest.fixture
def cfg(tmp_path):
    return jobs.JobConfig(source_path=str(write_fixtures(tmp_path / "input")), target_path=str(tmp_path / "out"), as_of="2023-09-15")


def published(spark, cfg):
    folder = jobs.purchases_publication(spark, cfg).newest()
    back = spark.read.option("header", True).option("sep", ";").csv(folder + "/rejected")
    return jobs.read_staging(spark, cfg).count(), back.count()


def test_a_crash_between_the_outputs_leaves_the_last_consistent_pair(spark, cfg, monkeypatch):
    jobs.run_postal_codes(spark, cfg)
    assert jobs.run_quarantine(spark, cfg) == {"written": 25, "rejected": 30}
    assert published(spark, cfg) == (25, 30)
    with open(cfg.src(cfg.purchases_file), "w", encoding="utf-8") as f:
        f.write(to_csv(purchase_rows()[:10]))
    monkeypatch.setattr(jobs, "write_csv", lambda *a, **k: (_ for _ in ()).throw(OSError("disk gone")))
    with pytest.raises(OSError):
        jobs.run_quarantine(spark, cfg)  # its accepted rows are written, its rejected ones are not
    assert published(spark, cfg) == (25, 30)
    monkeypatch.undo()
    stats = jobs.run_quarantine(spark, cfg)
    assert published(spark, cfg) == (stats["written"], stats["rejected"]) and stats["written"] + stats["rejected"] < 55
    assert jobs.purchases_publication(spark, cfg).runs() == [1, 3]


def test_malformed_lines_are_published_word_for_word(spark, cfg):
    jobs.run_postal_codes(spark, cfg)
    bad = ['only,three,"fields; here"', "x," * 30 + "y"]
    with open(cfg.src(cfg.purchases_file), "a", encoding="utf-8") as f:
        f.write("\n" + "\n".join(bad) + "\n")
    assert jobs.run_quarantine(spark, cfg) == {"written": 25, "rejected": 30, "malformed": 2}
    assert published(spark, cfg) == (25, 30)
    folder = jobs.purchases_publication(spark, cfg).newest()
    back = spark.read.option("header", True).option("sep", ";").option("escape", '"').csv(folder + "/malformed").collect()
    assert sorted(r.line for r in back) == sorted(bad)
    assert {r.reason for r in back} == {"wrong number of fields"} and all(r.file.endswith(cfg.purchases_file) for r in back)


def test_loads_of_the_job(spark, cfg):
    jobs.run_postal_codes(spark, cfg)
    cfg.load = "monday"
    assert jobs.run_quarantine(spark, cfg)["written"] == 25
    cfg.load = "tuesday"
    assert jobs.run_quarantine(spark, cfg)["written"] == 0


def test_publications_are_claimed(spark, tmp_path):
    p = Publication(spark, str(tmp_path / "p"))
    assert p.newest() is None
    for _ in range(3):
        with p.new_run(keep=2) as folder:
            claims.make_folder(spark, folder)
    assert p.runs() == [2, 3]


# ------------------------------------------------------------- history and graph


def test_history_is_idempotent(spark, tmp_path):
    h = RunHistory(spark, str(tmp_path / "history"))
    assert h.read().count() == 0
    h.record("r1", "load", {"written": 1})
    h.record("r1", "load", {"written": 5, "rejected": 2})
    h.record("r2", "load", {"written": 7})
    h.record("r2", "idle", {})
    assert rows(h.read().select("run", "step", "metric", "value")) == [("r1", "load", "rejected", 2), ("r1", "load", "written", 5), ("r2", "load", "written", 7)]
    assert h.counts("r2", "idle") == {} and h.counts("r3", "load") is None


def test_steps_wait_run_side_by_side_and_go_on_after_a_failure(spark, tmp_path):
    h = RunHistory(spark, str(tmp_path / "history"))
    gate, ran, broken = threading.Barrier(2, timeout=60), [], [True]

    def meet(name):
        def work(s):
            if broken[0]:
                gate.wait()  # both first steps must run at once
            s.conf.set("spark.sql.shuffle.partitions", "3")
            ran.append(name)
            return {"n": s.range(5).count()}

        return work

    def fail(s):
        if broken[0]:
            raise OSError("gone")
        ran.append("c")
        return {"n": 1}

    steps = [Step("a", meet("a")), Step("b", meet("b")), Step("c", fail, ["a", "b"]), Step("d", lambda s: ran.append("d") or {"n": 2}, ["c"])]
    with pytest.raises(OSError, match="gone") as e:
        run_steps(spark, steps, history=h, run="r", parallel=2)
    assert e.value.__notes__ == ["step 'c' failed; done: a, b"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    broken[0] = False
    assert run_steps(spark, steps, history=h, run="r") == {"a": {"n": 5}, "b": {"n": 5}, "c": {"n": 1}, "d": {"n": 2}}
    assert Counter(ran) == {"a": 1, "b": 1, "c": 1, "d": 1}
    with pytest.raises(ValueError):
        run_steps(spark, [Step("x", meet("x"), ["y"])])


def test_jobs_killed_at_a_step_go_on(spark, cfg, monkeypatch):
    real, seen = jobs.run_suppliers, []
    monkeypatch.setattr(jobs, "run_suppliers", lambda s, c: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError, match="killed"):
        jobs.run_all(spark, cfg, run="night")
    monkeypatch.setattr(jobs, "run_suppliers", lambda s, c: seen.append("suppliers") or real(s, c))
    monkeypatch.setattr(jobs, "run_quarantine", lambda s, c: (_ for _ in ()).throw(AssertionError("done already")))
    out = jobs.run_all(spark, cfg, run="night")
    assert seen == ["suppliers"] and out["quarantine"] == {"written": 25, "rejected": 30}
    assert out["PROGRAMACAO_PAGAMENTO"]["INSERT"] == 52
    told = jobs.run_history(spark, cfg).read().where("metric = 'INSERT'")
    assert {r.step: r.value for r in told.collect()}["FORNECEDORES"] == 23


# ------------------------------------------------- change sets, incremental schedule


def test_change_set(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, None, "c"), (None, "n", "n")], "k int, u string, v string")
    new = spark.createDataFrame([(1, "a", None), (2, "b", "y"), (3, "c", None), (4, "d", "d"), (None, "n", "n")], "k int, u string, v string")
    got = Counter((r.k, r._change) for r in change_set(old, new, ["k"]).collect())
    assert got == {(2, "update"): 1, (3, "update"): 1, (4, "insert"): 1, (None, "insert"): 1, (None, "delete"): 1}
    assert change_set(new, new.where("k IS NOT NULL"), ["k"]).where("k IS NOT NULL").count() == 0
    assert [tuple(r) for r in change_set(old, new, ["k"], ["u"]).where("k IS NOT NULL AND _change = 'update'").collect()] == [(3, "update")]


def test_incremental_schedule_equals_the_full_one(spark, tmp_path):
    from ledgerflow.operators import installment_schedule, refresh_status

    inv_schema = T.StructType().add("id", "long").add("issued", "date").add("total", T.DecimalType(10, 2)).add("term", "integer")
    invoices = BucketTable(spark, str(tmp_path / "inv"), inv_schema, ["id"], n_buckets=32)
    terms = BucketTable(spark, str(tmp_path / "terms"), T.StructType().add("term", "integer").add("n", "integer"), ["term"], n_buckets=2)
    sched_schema = T.StructType().add("row_id", "long").add("id", "long").add("due", "date").add("no", "integer").add("amount", T.DecimalType(21, 13)).add("status", "string")
    schedule = BucketTable(spark, str(tmp_path / "sched"), sched_schema, ["id", "no"], n_buckets=32, identity_col="row_id", bucket_by=["id"])
    now = ["2024-03-15"]

    def compute(df):
        counted = df.join(F.broadcast(terms.read()), "term", "left")
        out = installment_schedule(counted, id_col="id", issue_date_col="issued", total_col="total", count_col="n", due_col="due", number_col="no")
        return refresh_status(out, "due", "status", as_of=now[0])

    def refresh():
        return refresh_schedule(invoices, terms, schedule, compute, id_col="id", term_col="term", due_col="due", status_col="status", paid="PAID", pending="PENDING", as_of=now[0])

    def same():
        want = rows(compute(invoices.read()))
        assert rows(schedule.read().drop("row_id")) == want
        ids = [r.row_id for r in schedule.read().collect()]
        assert len(set(ids)) == len(ids) == len(want) and None not in ids

    def upsert(data):
        invoices.upsert(spark.createDataFrame([(i, d, Decimal(t), k) for i, d, t, k in data], inv_schema))

    terms.upsert(spark.createDataFrame([(1, 1), (2, 3), (3, 0)], "term int, n int"))
    day = dt.date(2024, 1, 31)
    upsert([(i, day, i, 1 + i % 3) for i in range(1, 400)])
    assert refresh()["invoices"] == 399
    same()
    kept = {(r.id, r.no): r.row_id for r in schedule.read().collect()}
    before = schedule.layout()
    upsert([(4, day, 999, 2), (10, day, 10, 3), (9001, day, 5, 2)])  # changed, without installments now, new
    got = refresh()
    assert got["invoices"] == 3 and got["buckets"] <= 3
    assert sum(schedule.layout()[b] != before.get(b) for b in schedule.layout()) == got["buckets"]
    same()
    assert all(kept[r.id, r.no] == r.row_id for r in schedule.read().collect() if (r.id, r.no) in kept)
    assert refresh() | {"buckets": 0} == {"INSERT": 0, "UPDATE": 0, "invoices": 0, "buckets": 0}
    now[0] = "2024-04-01"  # the third installments come due
    assert refresh()["invoices"] > 100
    same()
    terms.upsert(spark.createDataFrame([(3, 2)], "term int, n int"))
    refresh()
    same()


def test_jobs_with_bucketed_tables(spark, cfg):
    cfg.buckets = 4
    out = jobs.run_all(spark, cfg)
    assert out["FORNECEDORES"]["INSERT"] == 23 and out["NOTAS_FISCAIS_ENTRADA"]["INSERT"] == 25 and out["PROGRAMACAO_PAGAMENTO"]["INSERT"] == 52
    whole = jobs.JobConfig(source_path=cfg.source_path, target_path=cfg.target_path + "-whole", as_of=cfg.as_of)
    jobs.run_all(spark, whole)
    for name, drop in (("PROGRAMACAO_PAGAMENTO", ["ID_PROG_PAGAMENTO", "ID_NF_ENTRADA"]), ("NOTAS_FISCAIS_ENTRADA", ["ID_NF_ENTRADA", "ID_FORNECEDOR"])):
        a, b = (jobs.tables_for(spark, c).read(name).drop(*drop) for c in (cfg, whole))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    again = jobs.run_all(spark, cfg)
    assert again["PROGRAMACAO_PAGAMENTO"] == {"INSERT": 0, "UPDATE": 0}
    assert all(v.get("INSERT", 0) == 0 for v in again.values())
