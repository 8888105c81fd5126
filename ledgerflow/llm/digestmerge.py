"""Exact dedup by a tree merge of sorted digest runs (operator 13).

Every text is normalised (all ASCII blanks deleted) and digested twice: a
64-bit hash orders the runs, a SHA-256 verifies each meeting, so two texts
whose short hashes collide never merge. The digests are dealt over ``slots``
(a power of two), one sorted run each, equal digests of a run merged into one
entry (best row, number of rows). Then the slots exchange runs in binomial
rounds: in round r a slot talks to the 2**width slots that differ from it in
the r-th group of address bits and keeps the entries whose hash has its own
bits there. The runs that arrive are merged and equal digests become one
entry again. After the last round a slot holds the only entry of each of its
digests.

A group of copies, however large, is therefore at most one entry a slot and
round: no task ever reads more of it than one entry from each partner. The
winners go back down the same tree, an entry to at most 2**width partners a
round, and meet the rows of their slot. Each level is a written table under
``spark.checkpoint.dir``.

Defined results: a null or empty text counts as empty, as does one of blanks
alone, and all of these are equal; of equal texts the row with the most code
points in the original text stays, then the smallest id (a null id comes
last), then any one of rows that agree in both; each row counts, rows that
repeat id and text too, and just one row of a group is kept; an empty table
gives no rows; ids may be of any type that sorts; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.common import BLANKS, shared_table, ship

#: Address bits that a round settles: 2**WIDTH runs meet in a slot.
WIDTH = 3
_KEY = ["slot", "h", "sha"]


def slots_for(spark: SparkSession) -> int:
    """The power of two from the session's number of shuffle partitions on."""
    return 1 << (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()


def rounds(slots: int, width: int = WIDTH) -> list[int]:
    """The address bits that each round settles, as masks; a lone slot has one
    round, in which its rows meet."""
    bits = slots.bit_length() - 1
    return [((1 << min(width, bits - low)) - 1) << low for low in range(0, bits, width)] or [0]


def _partner(mask: int) -> Column:
    """The slot that an entry goes to: its own, with the hash's bits in ``mask``."""
    return (F.col("slot").bitwiseAND(F.lit(~mask)) + F.col("h").bitwiseAND(F.lit(mask)).cast("int")).cast("int")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One entry per (slot, h, sha) of a sorted stream: its first row, with the
    sum of ``n``. The last entry is held back, as the next batch may go on with it."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks().to_batches()[0]
        slot, h, n = (now.column(c).to_numpy() for c in ("slot", "h", "n"))
        sha = np.frombuffer(b"".join(now.column("sha").to_pylist()), "S32")
        new = (slot[1:] != slot[:-1]) | (h[1:] != h[:-1]) | (sha[1:] != sha[:-1])
        starts = np.flatnonzero(np.concatenate([[True], new]))
        out = now.take(pa.array(starts))
        out = out.set_column(out.schema.get_field_index("n"), "n", pa.array(np.add.reduceat(n, starts)))
        held = out.slice(out.num_rows - 1)
        yield out.slice(0, out.num_rows - 1)
    if held is not None:
        yield held


def _run(entries: DataFrame) -> DataFrame:
    """Each partition as a sorted run without repeated digests. Of equal
    digests the row that stays comes first."""
    best = [F.desc("chars"), F.asc_nulls_last("id"), F.asc("row")]
    return entries.sortWithinPartitions(*_KEY, *best).mapInArrow(_merged, entries.schema)


def digests(docs: DataFrame, slots: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(slot, h, sha, chars, id, row, n) of every row, written. A slot is the
    task that read the row, so slots are as even as the input's splits."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    bare = F.translate(text, BLANKS, "")
    rows = docs.select(
        F.pmod(F.spark_partition_id(), F.lit(slots)).alias("slot"), F.xxhash64(bare).alias("h"), F.unhex(F.sha2(bare, 256)).alias("sha"),
        F.length(text).alias("chars"), F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("row"), F.lit(1).cast("long").alias("n"),
    )
    return shared_table(rows, "digests")


def levels(rows: DataFrame, slots: int, width: int = WIDTH) -> list[DataFrame]:
    """The entries before the first round and after each one."""
    out = [shared_table(_run(rows), "digest-run-0")]
    for r, mask in enumerate(rounds(slots, width)):
        sent = out[-1].withColumn("slot", _partner(mask)).repartitionById(slots, "slot")
        out.append(shared_table(_run(sent), f"digest-run-{r + 1}"))
    return out


def winners(tree: list[DataFrame], slots: int, width: int = WIDTH) -> DataFrame:
    """(slot, h, sha, keep_id, keep_row, group_size) for the digests of the
    first level that more than one row has, sent down round by round."""
    told = tree[-1].where("n > 1").select(*_KEY, F.col("id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("n").alias("group_size"))
    for r, mask in reversed(list(enumerate(rounds(slots, width)))):
        asked = tree[r].select("slot", _partner(mask).alias("partner"), "h", "sha")
        asked = asked if r else asked.distinct()  # at first several tasks may share a slot
        answer = told.withColumnRenamed("slot", "partner")
        told = shared_table(asked.join(answer, ["partner", "h", "sha"]).drop("partner"), f"digest-answer-{r}")
    return told


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int | None = None, width: int = WIDTH) -> DataFrame:
    """Per row of ``docs``: its id, keep_id (the id of the row that stays),
    group_size, kept and text_sha256 (of the normalised text, lowercase hex)."""
    ship(docs.sparkSession)
    slots = slots or slots_for(docs.sparkSession)
    rows = digests(docs, slots, id_col, text_col)
    told = winners(levels(rows, slots, width), slots, width)
    alone = F.col("group_size").isNull()
    return rows.join(told, _KEY, "left").select(
        F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), (alone | (F.col("keep_row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
