"""Best-fit packing with large-item matching (operator 10).

Packing needs only the *lengths*: pieces of equal length are interchangeable.
So the corpus is tokenised once, the pieces' metadata is written to the shared
folder, and a histogram of at most ``capacity`` lengths (the only thing the
driver ever sees) is packed there as runs "``n`` sequences of this pattern":

* lengths above a third of the capacity ("large"): at most two fit in one
  sequence, so each one, longest first, is matched with the longest other
  large piece that still fits;
* the rest, longest first, goes to the sequence with the smallest gap that
  holds it; a new sequence is opened only when no gap does.

Each piece then finds its place by its rank among pieces of its length. The
ranks come from windows over (length, hash bucket) plus the buckets' offsets,
so a length that a third of all pieces have is ranked by many tasks.

Defined results: a null text is an empty one (one piece holding the end id);
repeated rows are packed once each; a null id is an id like any other; an
empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import shared_table

#: Beyond this many characters without a break a text takes the slower encoder,
#: whose merge loop is not quadratic in the length of one word.
LONG_RUN = 4096
#: Pieces that share one rank window, on average.
RANK_ROWS = 200_000


class Encoder:
    """Byte-level BPE of a ``tokenizers`` JSON file.

    Where the file's merges rank as their ids do, ``tiktoken`` gives the same
    ids several times faster; otherwise ``tokenizers`` itself is used.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._slow = Tokenizer.from_file(path)
        self._fast = self._ranked(path)

    @staticmethod
    def _ranked(path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        made = [model["vocab"].get("".join(m)) for m in merges]
        if (
            model.get("type") != "BPE"
            or pre.get("type") != "ByteLevel"
            or pre.get("add_prefix_space")
            or not pre.get("use_regex", True)
            or spec.get("normalizer")
            or model.get("ignore_merges")
            or None in made
            or made != sorted(made)
        ):
            return None
        # byte-level vocabularies write each byte as a printable character
        shown = [b for b in range(256) if chr(b).isprintable() and b != 32 and b != 0xAD]
        chars = {chr(b): b for b in shown}
        chars |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(chars[c] for c in word): i for word, i in model["vocab"].items() if word not in special}
        return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        words = text.split()
        blank = len(text) - sum(map(len, words))
        if self._fast is None or max(map(len, words), default=0) > LONG_RUN or blank > 2 * len(words) + LONG_RUN:
            return np.array(self._slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self._fast.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype("<u4", copy=False)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be short."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)] if n else []


def tokenized_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 (and ids)."""
    schema = "id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate([enc.ids(text.as_py() or ""), end])
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    raw = ids[start : start + length].tobytes()
                    rows.append((key, k, start, length, zlib.crc32(raw)) + ((raw,) if keep_ids else ()))
            names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * keep_ids
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Runs (number of sequences, lengths in each) that hold ``histogram``."""
    left = {n: c for n, c in histogram.items() if c > 0}
    gaps: dict[int, list[tuple[int, list[int]]]] = {}

    def put(count: int, lengths: list[int]) -> None:
        if count:
            gaps.setdefault(capacity - sum(lengths), []).append((count, lengths))

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left[n]:
            mate = next((m for m in large if m <= n and n + m <= capacity and left[m] > (m == n)), None)
            if mate is None:
                put(left[n], [n])
                left[n] = 0
            else:
                pairs = left[n] // 2 if mate == n else min(left[n], left[mate])
                put(pairs, [n, mate])
                left[n] -= pairs
                left[mate] -= pairs
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            gap = next((g for g in range(n, capacity) if gaps.get(g)), None)
            # a sequence that took one stays the tightest, so it takes all it can
            fits = (capacity if gap is None else gap) // n
            count, lengths = gaps[gap].pop() if gap is not None else (max(1, left[n] // fits), [])
            full = min(count, left[n] // fits)
            put(full, lengths + [n] * fits)
            left[n] -= full * fits
            if full < count and left[n]:
                put(1, lengths + [n] * left[n])
                left[n], full = 0, full + 1
            if gap is not None:
                put(count - full, lengths)
    return [run for g in sorted(gaps) for run in gaps[g]]


def places(runs: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first rank, first sequence and offset of each place's run."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for count, lengths in runs:
        offset = 0
        for n in lengths:
            rank = ranks.get(n, 0)
            found.setdefault(n, []).append((rank, sequence, offset))
            ranks[n], offset = rank + count, offset + n
        sequence += count
    return {n: tuple(np.array(x, dtype=np.int64) for x in zip(*rows)) for n, rows in found.items()}


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``tokenized_pieces``' rows.

    Returns every column of ``pieces``. ``pieces`` is read twice: pass a
    written table (``pack_documents`` does).
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    layout = spark.sparkContext.broadcast(places(plan(histogram, capacity)))
    buckets = 64 + sum(histogram.values()) // RANK_ROWS
    bucket: Column = F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(buckets)).cast("int")
    rows = pieces.withColumn("bucket", bucket)
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        rows.groupBy("length", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    within = Window.partitionBy("length", "bucket").orderBy("id", "piece", "ids_crc32")
    ranked = rows.withColumn("rank", F.row_number().over(within) - 1).join(bases, ["length", "bucket"])
    ranked = ranked.select(*pieces.columns, (F.col("rank") + F.col("base")).cast("long").alias("rank"))
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = layout.value
        for batch in batches:
            length = batch.column(names.index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(len(names)).to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                first, seq, off = table[int(n)]
                k = np.searchsorted(first, rank[at], side="right") - 1
                sequence[at], offset[at] = seq[k] + rank[at] - first[k], off[k]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False
) -> DataFrame:
    """Tokenise and pack: one row per piece with its sequence and offset."""
    pieces = shared_table(tokenized_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, keep_ids), "pieces")
    return pack(pieces, capacity).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """The token rows themselves: ``sequence_id``, ``ids`` (binary, u32 little
    endian). ``packed`` must carry ``ids``; a sequence is at most ``capacity``
    ids, so its group is bounded."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.unhex(F.lit("")), lambda acc, p: F.concat(acc, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
