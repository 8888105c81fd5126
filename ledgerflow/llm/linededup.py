"""Line dedup that returns keep bitmaps (operator 8).

Every line's 128-bit key digest is range-partitioned together with document
and position and sorted inside its partition, so each partition streams its
keys once, in order, and the first document of a key is its keeper. A key
that many documents share spans several partitions instead of filling one:
each partition leaves its first and its last key open (their runs may go on
next door), and the open keys' keepers are found by a partial ``min``.

The result is one zlib-compressed bitmap per document (bit *i* of the
big-endian ``packbits`` is 1 when line *i* stays), not text; ``apply_keep``
turns it back into text.

Defined results: null or empty text is one empty line, kept; rows with equal
id count as one document (never as copies of each other) and each gets its own
bitmap; a null id is the smallest document; an empty table gives no rows;
other columns are ignored by ``line_keep_bitmaps`` and kept by ``apply_keep``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from ledgerflow.llm.common import BLANKS, keyed_rows, shared_table, unpacked

_BLANK_BYTES = BLANKS.encode()
_LINES = "h1 long, h2 long, id long, text_hash long, pos int"
_MARKS = "h1 long, h2 long, id long, text_hash long, pos int, open boolean"
_HELD = 100_000


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The line stripped of ASCII blanks with A-Z lower-cased; None when short."""
    key = line.strip(_BLANK_BYTES).lower()  # bytes.lower changes A-Z alone
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return key


def _line_hashes(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, owner, pos = [], [], []
            for row, text in enumerate(batch.column(2)):
                for k, line in enumerate((text.as_py() or "").encode().split(b"\n")):
                    if (key := line_key(line, min_chars)) is not None:
                        digests.append(hashlib.blake2b(key, digest_size=16).digest())
                        owner.append(row)
                        pos.append(k)
            h = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            take = pa.array(owner, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), batch.column(0).take(take), batch.column(1).take(take), pa.array(pos, pa.int32())],
                names=["h1", "h2", "id", "text_hash", "pos"],
            )

    return run


def _marks(table: pa.Table, is_open: bool) -> list[pa.RecordBatch]:
    return table.append_column("open", pa.array(np.full(len(table), is_open))).combine_chunks().to_batches()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks from one sorted partition: the lines that go, and every line of
    the partition's first and last key (``open``).

    The last key read so far is held back until its run ends; a run that
    outgrows ``_HELD`` lines is handed out as open instead.
    """
    tail: pa.Table | None = None
    first = True
    for batch in batches:
        now = pa.Table.from_batches([batch])
        if tail is not None:
            now = pa.concat_tables([tail, now]).combine_chunks()
        tail = None
        if not len(now):
            continue
        h1, h2, ids = (now.column(c).to_numpy() for c in ("h1", "h2", "id"))
        starts = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        head = (starts[1] if len(starts) > 1 else len(now)) if first else 0
        last = max(starts[-1], head)
        yield from _marks(now.slice(0, head), True)
        inner = starts[(starts >= head) & (starts < last)]
        if len(inner):
            keeper = np.repeat(ids[inner], np.diff(np.r_[inner, last]))
            lost = np.flatnonzero(ids[head:last] != keeper) + head
            yield from _marks(now.take(pa.array(lost)), False)
        first = first and len(starts) == 1
        tail = now.slice(last)
        if len(tail) > _HELD:
            yield from _marks(tail, True)
            tail, first = None, True
    if tail is not None:
        yield from _marks(tail, True)


def _id(col: str) -> Column:
    """The id as a long; a null id counts as the smallest one."""
    return F.coalesce(F.col(col).cast("long"), F.lit(-(2**63)))


def line_marks(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, pos) of every line that goes."""
    text = F.col(text_col)
    lines = docs.select(_id(id_col), F.xxhash64(text), text).mapInArrow(_line_hashes(min_chars), _LINES)
    lines = shared_table(lines, "lines")  # the range sampler reads it once more
    order = ["h1", "h2", "id", "pos"]
    marks = shared_table(lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_runs, _MARKS), "line-marks")
    still_open = marks.where("open")
    # a few keys a partition are open, whatever their number of lines: few
    # enough to broadcast (two a partition, and one for each _HELD lines)
    keepers = still_open.groupBy("h1", "h2").agg(F.min("id").alias("keeper"))
    lost = still_open.join(F.broadcast(keepers), ["h1", "h2"]).where("id > keeper")
    return marks.where("not open").select("id", "text_hash", "pos").unionByName(lost.select("id", "text_hash", "pos"))


@F.pandas_udf(BinaryType())
def _bitmap(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    out = []
    for n, gone in zip(n_lines, dropped):
        keep = np.ones(n, dtype=bool)
        if gone is not None:
            keep[np.asarray(gone, dtype=np.int64)] = False
        out.append(zlib.compress(np.packbits(keep).tobytes()))
    return pd.Series(out)


def unpack_bitmap(packed: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=n_lines).astype(bool)


def line_keep_bitmaps(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, text_hash, n_lines, n_dropped, keep_bitmap."""
    marks = line_marks(docs, min_chars, id_col, text_col)
    gone = marks.groupBy("id", "text_hash").agg(F.collect_set("pos").alias("gone"))  # bounded by one document's lines
    text = F.coalesce(F.col(text_col), F.lit(""))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    rows = docs.select(_id(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), (breaks + 1).cast("long").alias("n_lines"), F.col(id_col).cast("long").alias("_own"))
    joined = rows.join(gone, ["id", "text_hash"], "left")
    dropped = F.coalesce(F.size("gone"), F.lit(0)).cast("long")
    return joined.select(
        F.col("_own").alias(id_col), "text_hash", "n_lines", dropped.alias("n_dropped"), _bitmap("n_lines", "gone").alias("keep_bitmap")
    )


@F.pandas_udf(StringType())
def _kept(text: pd.Series, packed: pd.Series, n_lines: pd.Series) -> pd.Series:
    out = []
    for t, bits, n in zip(text, packed, n_lines):
        keep = unpack_bitmap(bits, n)
        out.append("\n".join(line for line, k in zip((t or "").split("\n"), keep) if k))
    return pd.Series(out, dtype=object)


def apply_keep(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` cut to its kept lines, plus ``n_lines`` and
    ``n_dropped`` (a column of that name in ``docs`` is replaced)."""
    known = bitmaps.select(_id(id_col).alias("id"), "text_hash", F.struct("n_lines", "n_dropped", "keep_bitmap").alias("b")).dropDuplicates(["id", "text_hash"])
    rows = keyed_rows(docs, id_col, text_col).withColumn("id", F.coalesce("id", F.lit(-(2**63)))).join(known, ["id", "text_hash"])
    text = F.col("row").getField(text_col)
    kept = F.when(F.col("b.n_dropped") == 0, F.coalesce(text, F.lit(""))).otherwise(_kept(text, F.col("b.keep_bitmap"), F.col("b.n_lines")))
    return unpacked(rows, docs.columns, **{text_col: kept, "n_lines": F.col("b.n_lines"), "n_dropped": F.col("b.n_dropped")})
