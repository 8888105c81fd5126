import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_docs import make_docs
from tokenizers import Tokenizer

from ledgerflow.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["Hello there, it's 12 o'clock!\n\n  x", "", None, " ", "déjà vu 三 😀 　 \xa0\x1cq", "word " * 5000, "a" * 6000, "<|endoftext|> is no end", "tab\t\ttab \n", "word " * 340, "word " * 1023, "word " * 1024]


@pytest.fixture(scope="module")
def slow():
    return Tokenizer.from_file(PATH)


def test_fast_ids_equal_the_tokenizers_library(slow):
    enc = packing.Encoder(PATH)
    assert enc._fast is not None
    for t in TEXTS:
        assert enc.ids(t or "").tolist() == slow.encode(t or "", add_special_tokens=False).ids


def test_pieces_places_and_round_trip(llm_spark, slow):
    rows = list(enumerate(TEXTS)) + [(0, TEXTS[0]), (None, "no id")]
    packed = packing.pack_documents(make_docs(llm_spark, rows), PATH, keep_ids=True).cache()
    got = packed.collect()
    by_sequence = {}
    for r in got:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length <= 4096
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():  # gapless from 0
        places.sort()
        assert [o for o, _ in places] == np.cumsum([0, *(n for _, n in places[:-1])]).tolist()
        assert sum(n for _, n in places) <= 1024
    for i, text in enumerate(TEXTS):
        ids = slow.encode(text or "", add_special_tokens=False).ids + [2]
        mine = sorted({(r.piece, r.start, bytes(r.ids)) for r in got if r.doc_id == i})
        assert b"".join(p[2] for p in mine) == np.array(ids, "<u4").tobytes()
        assert [p[1] for p in mine] == [s for s, _ in packing.cut(len(ids), 1024)]
        assert all(len(p[2]) == 4096 for p in mine[1:])
    assert sum(r.length for r in got if r.doc_id == 0) == 2 * (len(slow.encode(TEXTS[0]).ids) + 1)
    assert {len(r.ids) // 4 for r in packing.sequences(packed).collect()} == {sum(n for _, n in p) for p in by_sequence.values()}


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_piece_and_wastes_little(seed):
    rng = random.Random(seed)
    lengths = [min(1024, 1 + int(rng.expovariate(1 / rng.choice([60, 300, 700])))) for _ in range(3000)]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    runs = packing.plan(histogram, 1024)
    held = {}
    for count, pattern in runs:
        assert sum(pattern) <= 1024 and count > 0 and sum(3 * n > 1024 for n in pattern) <= 2
        for n in pattern:
            held[n] = held.get(n, 0) + count
    assert held == histogram
    used = sum(c for c, _ in runs)
    # as few as best-fit decreasing, item by item
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(1024 - n)
    assert used <= len(gaps) * 1.01 + 1
    assert used >= sum(lengths) / 1024


def test_places_cover_all_ranks():
    table = packing.places(packing.plan({700: 5, 324: 7, 10: 50}, 1024))
    for n, count in {700: 5, 324: 7, 10: 50}.items():
        first, _, _ = table[n]
        assert first[0] == 0 and (np.diff(first) > 0).all() and first[-1] < count


def test_empty_table(empty):
    assert packing.pack_documents(empty, PATH).count() == 0
