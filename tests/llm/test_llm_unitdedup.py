import re

import pytest
from llm_docs import make_docs, words

from ledgerflow.llm import unitdedup


def brute(rows, unit, least):
    separator = re.compile(unitdedup.SEPARATORS[unit])
    docs = sorted(set(rows), key=lambda r: r[0])
    units, first = {}, {}
    for i, text in docs:
        found, start = [], 0
        for m in [*separator.finditer(text or ""), None]:
            stop = m.start() if m else len(text or "")
            w = (text or "")[start:stop].lower().split()
            if w:
                found.append((start, stop, " ".join(w), len(w)))
            start = m.end() if m else stop
        units[i] = found
        for k, u in enumerate(found):
            first.setdefault(u[2], (i, k))
    out = set()
    for i, found in units.items():
        run = None
        for k, u in enumerate([*found, None]):
            if u and first[u[2]] != (i, k):
                run = (run[0], u[1], run[2] + u[3]) if run else (u[0], u[1], u[3])
            else:
                if run and run[2] >= least:
                    out.add((i, *run))
                run = None
    return out


SENTENCES = [" ".join(words(s, 6 + s % 9)).capitalize() + "." for s in range(40)]
PASSAGE = " ".join(SENTENCES[:8])
ROWS = [(i, f"{' '.join(words(1000 + i, 40))} {PASSAGE} {' '.join(words(2000 + i, 20))}\n{SENTENCES[20]}") for i in range(60)]
ROWS += [(70, None), (71, ""), (72, " \n\t"), (73, "\n\n".join(SENTENCES[25:30])), (74, "\n\n".join(SENTENCES[25:30]).upper()), (75, SENTENCES[30] + " " + SENTENCES[30])]
ROWS += [(76, " ".join(words(5, 60000)) + " " + PASSAGE)]


@pytest.mark.parametrize("unit", ["clause", "line", "paragraph"])
def test_equals_brute_force(llm_spark, monkeypatch, unit):
    got = {(r.doc_id, r.start, r.stop, r.n_words) for r in unitdedup.repeated_passages(make_docs(llm_spark, ROWS + ROWS[:5], 7), unit, 5).collect()}
    assert got == brute(ROWS, unit, 5)


def test_small_blocks_give_the_same(llm_spark):
    rows = make_docs(llm_spark, ROWS, 2)
    one = {(r.doc_id, r.start, r.stop) for r in unitdedup.repeated_passages(rows, "clause", 20).collect()}
    other = {(r.doc_id, r.start, r.stop) for r in unitdedup.repeated_passages(rows.repartition(40), "clause", 20).collect()}
    assert one == other == {x[:3] for x in brute(ROWS, "clause", 20)}


def test_sure_repeats_of_a_block():
    import numpy as np

    rows = np.array([[5, 2, 0, 0, 0, 9, 3], [5, 1, 0, 4, 20, 29, 3], [5, 1, 0, 7, 40, 49, 3], [6, 1, 0, 0, 0, 9, 3], [6, 1, 0, 0, 0, 9, 3]])
    first, sure = unitdedup._split(rows)
    assert [(r["digest"], r["id"], r["seq"]) for r in first.to_pylist()] == [(5, 1, 4), (6, 1, 0)]
    assert [(r["id"], r["seq"], r["earlier"]) for r in sure.to_pylist()] == [(1, 7, 1), (2, 0, 1)]


def test_spans_cut_the_original(llm_spark):
    docs = make_docs(llm_spark, ROWS[:4] + [(None, None)])
    cut = unitdedup.remove_spans(docs, unitdedup.repeated_passages(docs, "clause", 20))
    assert cut.columns == [*docs.columns, "removed"]
    texts = dict(ROWS)
    for r in cut.collect():
        if r.doc_id:
            kept, at = "", 0
            for s in r.removed:
                kept, at = kept + texts[r.doc_id][at : s.start], s.stop
            assert r.text == kept + texts[r.doc_id][at:] and r.removed
        else:
            assert not r.removed


def test_passages_are_extended_by_words(llm_spark):
    a, b, c = " ".join(words(1, 20)), " ".join(words(2, 6)), " ".join(words(3, 400))
    passage = f"{a}, {b}, {c}"  # one whole clause of six words; a long cut one on each side
    line = "Read more here."
    rows = [(1, f"x1 {passage} y1\n{line}"), (2, f"x2 z2 {passage} y2\n{line}"), (3, f"x3 {a.upper()},\n{b}, v w"), (4, f"{line} q\n\n{line}"), (None, "other text, of no concern"), (5, "w, w w, w")]
    texts = dict(rows)
    found = unitdedup.extended_passages(make_docs(llm_spark, rows + rows[:2]), 25).collect()
    assert all(r.earlier_id < r.doc_id for r in found)
    got = sorted((r.doc_id, r.n_words, texts[r.doc_id][r.start : r.stop]) for r in found)
    assert got == [(2, 3, line), (2, 426, passage), (3, 26, f"{a.upper()},\n{b},"), (4, 3, line)]
    assert unitdedup.extended_passages(make_docs(llm_spark, [(1, None), (2, "")]), 25).count() == 0


def test_empty_table(empty):
    passages = unitdedup.repeated_passages(empty, "clause")
    assert passages.count() == 0 and unitdedup.remove_spans(empty, passages).count() == 0


def brute_extended(rows, least):
    """``extended_passages`` word by word: from every run of repeated clauses
    on, both texts are compared one word at a time."""
    clause = re.compile(unitdedup.SEPARATORS["clause"])
    texts = dict(sorted(set(rows), key=lambda r: r[0]))
    words_of = {i: [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"\S+", t)] for i, t in texts.items()}
    first, units = {}, {}
    for i, t in texts.items():
        units[i] = unitdedup.units_of(t, clause)
        for u in units[i]:
            first.setdefault(u[2], (i, u[0], u[1]))
    wholes, seen = {}, {}
    for i, t in texts.items():
        wholes[i] = unitdedup.clauses_and_wholes(t, clause)[1]
        for u in wholes[i]:
            seen.setdefault(u[2], (i, u[0]))
    out = set()
    for i, t in texts.items():
        mine, spans, k = words_of[i], [], 0
        while k < len(units[i]):
            j = k
            while j < len(units[i]) and first[units[i][j][2]][:2] != (i, units[i][j][0]):
                j += 1
            if j > k and sum(u[3] for u in units[i][k:j]) >= unitdedup.SEED_WORDS:
                (x, x_start, x_stop), (y, y_start, y_stop) = first[units[i][k][2]], first[units[i][j - 1][2]]
                a = sum(w[0] < units[i][k][0] for w in mine)
                b = sum(w[0] < units[i][j - 1][1] for w in mine)
                left = sum(w[0] < x_start for w in words_of[x])
                right = sum(w[0] < y_stop for w in words_of[y])
                lo, hi = a, b
                while lo > 0 and left > 0 and mine[lo - 1][2] == words_of[x][left - 1][2]:
                    lo, left = lo - 1, left - 1
                while hi < len(mine) and right < len(words_of[y]) and mine[hi][2] == words_of[y][right][2]:
                    hi, right = hi + 1, right + 1
                spans.append((lo, hi))
            k = max(j, k + 1)
        spans = [s[:2] for s in unitdedup._merged([(*s, 0, 0, 0) for s in spans]) if s[1] - s[0] >= least]
        spans += [(sum(w[0] < u[0] for w in mine), sum(w[0] < u[1] for w in mine)) for u in wholes[i] if seen[u[2]] != (i, u[0])]
        out |= {(i, *s[:2]) for s in unitdedup._merged([(*s, 0, 0, 0) for s in spans])}
    return out


@pytest.mark.parametrize("seed", range(2))
def test_extended_passages_equal_brute_force(llm_spark, seed):
    import random

    rng = random.Random(seed)
    pieces = [" ".join(words(seed * 100 + s, 5 + s % 12)) + rng.choice([".", ",", "!", ""]) for s in range(25)]
    rows = []
    for i in range(40):
        parts = [rng.choice(pieces) if rng.random() < 0.6 else " ".join(words(5000 + 100 * seed + 40 * i + k, 7)) for k in range(12)]
        rows.append((i, "".join(p + rng.choice([" ", " ", ", ", "\n", "\n\n"]) for p in parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1].upper()), (102, "x " * 3000 + rows[5][1])]
    texts = dict(rows)
    got = set()
    # in one task, so that the earlier occurrence is the first of all
    for r in unitdedup.extended_passages(make_docs(llm_spark, rows, 1), 12).collect():
        starts = [m.start() for m in re.finditer(r"\S+", texts[r.doc_id])]
        got.add((r.doc_id, sum(s < r.start for s in starts), sum(s < r.stop for s in starts)))
    assert got == brute_extended(rows, 12)


def test_a_line_is_no_repeat_of_the_paragraph_that_it_is():
    clause = re.compile(unitdedup.SEPARATORS["clause"])
    for text, n in (("a b.\n\nc d\n", 2), ("a b.\n\n  c d", 2), ("a\nb\n\nc\n", 4), ("a\n \n b", 2), ("one line", 1)):
        wholes = unitdedup.clauses_and_wholes(text, clause)[1]
        assert len(wholes) == len({u[2] for u in wholes}) == n, text


def test_copies_of_a_row_cost_no_more_than_one(llm_spark, monkeypatch):
    """Rows that repeat id and text are one document at every step."""
    sizes = {}
    real = unitdedup.shared_table

    def counted(df, name):
        out = real(df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(unitdedup, "shared_table", counted)
    text = " ".join(words(7, 40)) + ". " + " ".join(words(8, 30)) + "."
    one = [(1, text + " a b c."), (2, "d e f. " + text)]
    plain = sorted(map(tuple, unitdedup.extended_passages(make_docs(llm_spark, one), 25).collect()))
    before = dict(sizes)
    sizes.clear()
    many = sorted(map(tuple, unitdedup.extended_passages(make_docs(llm_spark, one * 60, 6), 25).collect()))
    assert many == plain and len(plain) == 1
    assert {k: sizes[k] for k in ("asked", "contexts", "extended")} == {k: before[k] for k in ("asked", "contexts", "extended")}
