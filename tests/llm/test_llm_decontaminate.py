import re

from llm_docs import make_docs, words

from ledgerflow.llm import decontaminate


def shingles(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def brute(docs, items):
    best = {}
    for i, text in docs:
        for k, item in items:
            size = min(5, len((item or "").split()))
            want = shingles(item, size) if size else set()
            both = len(shingles(text, size) & want)
            if want and 100 * both >= 75 * len(want):
                best[i, k, text] = max(best.get((i, k, text), (0, 0, 0)), (both / len(want), len(want), both))
    return {(i, k, both, n) for (i, k, _), (_, n, both) in best.items()}


ITEMS = [(k, " ".join(words(k, n))) for k, n in enumerate([5, 6, 9, 14, 15, 16, 17, 33, 40, 64, 65, 130, 3, 0])] + [(20, None), (21, " "), (22, "Aa bb cc dd ee " * 9)]


def damaged(text, every):
    w = text.split()
    return " ".join("zzz" if i % every == every - 1 else x for i, x in enumerate(w))


def documents():
    rows = []
    for k, item in ITEMS:
        for j, every in enumerate([1000, 60, 30, 21, 18]):
            around = " ".join(words(900 + 7 * len(rows), 30 * (j + 1)))
            rows.append((len(rows), f"{around} {damaged(item or '', every).upper() if j == 1 else damaged(item or '', every)}\t{around}"))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "aa bb cc dd ee " * 3)]
    rows += [(504, " ".join(words(77, 150000)) + " " + ITEMS[8][1]), (504, "other text of the same id"), (505, ITEMS[7][1]), (505, ITEMS[7][1]), (None, ITEMS[9][1])]
    return rows


def test_equals_brute_force(llm_spark):
    docs = make_docs(llm_spark, documents())
    items = llm_spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contained_items(docs, items).collect()
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got} == brute(documents(), ITEMS)
    assert len(got) == len({(r.doc_id, r.text_hash, r.item_id) for r in got})


def test_shuffled_joins_give_the_same(llm_spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    llm_spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = llm_spark.createDataFrame(ITEMS, "item_id long, text string")
        got = decontaminate.contained_items(make_docs(llm_spark, documents()), items).collect()
    finally:
        llm_spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got} == brute(documents(), ITEMS)


def test_contaminated_rows_go_and_clean_rows_stay(llm_spark):
    docs = make_docs(llm_spark, documents())
    kept = decontaminate.drop_contaminated(docs, llm_spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert kept.columns == docs.columns
    bad = {i for i, *_ in brute(documents(), ITEMS)}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted([str(i) for i, _ in documents() if i not in bad] + ["504"])


def test_no_python_on_the_main_path(llm_spark):
    plan = decontaminate.contained_items(make_docs(llm_spark, documents()), llm_spark.createDataFrame(ITEMS, "item_id long, text string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty_tables(llm_spark, empty):
    none = llm_spark.createDataFrame([], "item_id long, text string")
    items = llm_spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contained_items(empty, items).count() == 0
    assert decontaminate.drop_contaminated(make_docs(llm_spark, [(1, "a")]), none).count() == 1


def test_texts_of_one_item_id_are_sought_each_on_its_own(llm_spark):
    short, long = " ".join(words(700, 12)), " ".join(words(701, 90))
    items = [(7, short), (7, long), (7, short), (None, " ".join(words(702, 9))), (None, " ".join(words(703, 8)))]
    half = " ".join(words(701, 90)[:40])
    docs = [(1, f"a b {short} c"), (2, f"{half} {short}"), (3, half), (4, f"{long} x {short}"), (5, " ".join(words(702, 9))), (6, " ".join(words(703, 8)))]
    got = decontaminate.contained_items(make_docs(llm_spark, docs), llm_spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got} == brute(docs, items) == {(1, 7, 8, 8), (2, 7, 8, 8), (4, 7, 86, 86), (5, None, 5, 5), (6, None, 4, 4)}
    assert all(r.containment <= 1 for r in got)


def test_items_of_one_to_four_words(llm_spark):
    items = [(n, " ".join(words(800 + n, n))) for n in range(1, 5)] + [(9, words(804, 4)[0] + " " + words(804, 4)[2])]
    docs = [(10 * n + j, f"{'p q ' * j}{text.upper()}{' r s t u v' * j}") for n, text in items for j in range(2)]
    docs += [(200, words(804, 4)[0]), (201, " ".join(words(804, 4)[:3]) + " x " + words(804, 4)[3]), (202, " ".join(words(5, 60)))]
    got = decontaminate.contained_items(make_docs(llm_spark, docs), llm_spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got} == brute(docs, items)
    assert {r.item_id for r in got} == {1, 2, 3, 4, 9}


def test_a_shingle_that_every_document_and_item_has(llm_spark):
    common = " ".join(words(1, 5))
    items = [(k, f"{common} " + " ".join(words(1000 + k, 6))) for k in range(40)]
    docs = [(i, f"{common} " + " ".join(words(1000 + i % 60, 6)) + " " + " ".join(words(2000 + i, 20))) for i in range(120)]
    got = decontaminate.contained_items(make_docs(llm_spark, docs), llm_spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got} == brute(docs, items)
