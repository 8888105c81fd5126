import re

import pytest
from llm_docs import make_docs

from ledgerflow.llm import licenses

TEXTS = [
    "Licensed under CC BY-NC 4.0. cc by cc by",
    "released under the MIT licence. All rights\treserved",
    "GNU General  Public, License",
    "the apache licence: Licenced under the Apache License, Version 2.0",
    "Releasedunder the MIT Lisence here",
    "ccby general publics license",
    "",
    None,
    "É cc İ by cc_by 三 cc by",
    "x " * 30000 + "all rights reserved",
]


def brute(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_base_columns_equal_brute_force(llm_spark):
    docs = make_docs(llm_spark, list(enumerate(TEXTS)) + [(0, TEXTS[0]), (None, TEXTS[1])])
    rows = licenses.license_report(licenses.scan_licenses(docs)).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        text = TEXTS[1 if r.doc_id is None else r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text)
        assert 0 <= r.score <= 1
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels


def test_fuzzy_labels_and_spans(llm_spark):
    docs = make_docs(llm_spark, list(enumerate(TEXTS)))
    got = {r.doc_id: r for r in licenses.license_report(licenses.scan_licenses(docs)).collect()}
    assert got[0].labels == "cc-by,cc-by-nc"
    assert got[1].labels == "mit,reserved"
    assert "apache-2.0" in got[3].labels
    assert [(s.label, s.edits) for s in got[4].notices] == [("mit", 3)]
    assert got[4].score == pytest.approx(1 - 3 / 30)
    assert got[6].labels == got[7].labels == "" and got[7].score == 0
    assert got[9].first_word == 30000


def test_every_planted_edit_within_the_bound_is_found():
    scan = licenses.Scanner(licenses.PHRASES, licenses.NOTICES, licenses.EDIT_CHARS)
    notice = "released under the mit license"
    for k in range(len(notice)):
        for edited in (notice[:k] + notice[k + 1 :], notice[:k] + "q" + notice[k:], notice[:k] + "q" + notice[k + 1 :]):
            found = scan.fuzzy(f" foo bar {edited} baz ")
            assert [s[0] for s in found] == ["mit"], edited


def test_noisy_copies_beside_an_exact_one_each_have_a_span():
    scan = licenses.Scanner(licenses.PHRASES, licenses.NOTICES, licenses.EDIT_CHARS)
    lines = ["releasd under the mit license", "released under the mit license", "released undr the mit licens", "relesed under teh mit license"]
    for some in ([0, 1], [1, 0], [0, 2, 1, 3], [0, 0, 2, 3, 1, 2, 0, 1, 1, 3], [3, 2, 0]):
        found = scan.fuzzy(" " + " ".join(lines[k] for k in some) + " x ")
        assert [(s[0], s[1], s[2], s[3]) for s in found] == [("mit", 5 * i, 5 * i + 4, [1, 0, 2, 3][k]) for i, k in enumerate(some)]


@pytest.mark.parametrize(
    "text, labels",
    [
        ("licensed under cc by 4 0", ["cc-by"]),
        ("licensed under cc by", ["cc-by"]),
        ("licenced under ccby 4 0", ["cc-by"]),
        ("licensed under cc by nd 4 0", ["cc-by-nd"]),
        ("licensd under cc by nc 4 0", ["cc-by-nc"]),
        ("licensed under cc bysa 4 0", ["cc-by-sa"]),
        ("licensed under cc by nc sa 4 0", ["cc-by-nc-sa"]),
        ("licensed uner cc by nc nd", ["cc-by-nc-nd"]),
        ("licensed under cc0 1 0", []),
        ("licensed under cc by licensed under cc by sa", ["cc-by", "cc-by-sa"]),
        ("creative commons attribution 4 0", ["cc-by"]),
        ("creative commons attribution noncomercial share alike 4 0", ["cc-by-nc-sa"]),
        ("creative commons attribution noderivatives", ["cc-by-nd"]),
        ("licensed under the apache license version 2 0", ["apache-2.0"]),
        ("licensed under the apache license version 1 1", ["apache-1.1"]),
        ("released under the bsd license", []),
        ("released under the gpl license", []),
    ],
)
def test_notices_that_differ_by_few_letters_are_told_apart(text, labels):
    scan = licenses.Scanner(licenses.PHRASES, licenses.NOTICES, licenses.EDIT_CHARS)
    assert [s[0] for s in scan.fuzzy(f" see {text} x ")] == labels


def test_empty_table(empty):
    assert licenses.license_report(licenses.scan_licenses(empty)).count() == 0


def test_long_texts_full_of_notices_are_scanned_in_linear_time():
    import time

    scan = licenses.scanner(tuple(licenses.PHRASES.items()), tuple(licenses.NOTICES.items()), licenses.EDIT_CHARS)
    notice = max((t for t in licenses.NOTICES), key=len).replace("[", "").replace("]", "")
    one = f"{notice} all rights reserved released under the mit license "
    took = []
    for copies in (400, 1600):
        words = licenses.words_of(one * copies)
        began = time.process_time()
        found, exact = scan.fuzzy(words.decode()), scan.exact(words)
        took.append(time.process_time() - began)
        alone = scan.fuzzy(licenses.words_of(one).decode())
        n = len(licenses.words_of(one).split())
        assert [s[:3] for s in found] == [(label, first + n * k, last + n * k) for k in range(copies) for label, first, last, *_ in alone]
        assert len(exact) == copies * len(scan.exact(licenses.words_of(one)))
    assert took[1] < 8 * took[0] + 1

