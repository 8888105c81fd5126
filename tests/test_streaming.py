from collections import Counter

from fixtures import purchase_rows, to_csv, write_fixtures
from ledgerflow.plans import jobs
from ledgerflow.streaming import start_quarantine_stream


def test_stream_quarantine_matches_batch(spark, tmp_path):
    src = write_fixtures(tmp_path / "input")
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "part1.csv").write_text(to_csv(purchase_rows()), encoding="utf-8")
    postal = jobs.compute_postal_codes(spark, str(src / "postal_codes.csv"))
    out = tmp_path / "out"
    q = start_quarantine_stream(spark, str(landing), postal, str(out))
    q.awaitTermination(300)
    assert q.exception() is None
    acc = spark.read.parquet(str(out / "staging"))
    rej = spark.read.option("header", True).option("sep", ";").csv(str(out / "rejected"))
    assert acc.count() == 25
    assert Counter(r["inconsistencies"] for r in rej.collect()) == {
        "invalid CNPJ": 22, "null column(s)": 4, "null column(s), invalid CNPJ": 2, "duplicated": 2,
    }
    # a second file arriving later is processed as its own batch
    (landing / "part2.csv").write_text(to_csv(purchase_rows()[:3]), encoding="utf-8")
    q = start_quarantine_stream(spark, str(landing), postal, str(out))
    q.awaitTermination(300)
    batches = {p.name for p in (out / "staging").iterdir() if p.name.startswith("batch=")}
    assert len(batches) == 2
