"""Benchmark decontamination by size-partitioned MinHash containment
(operator 4), in DataFrame operations only.

An item of s shingles is contained when a document holds at least
``need = ceil(t * s)`` of them. MinHash sketches are the smallest hash values
of a set. An item's sketch is its ``s - need + 1`` smallest: a document that
lacks all of them lacks too many, so every containing document shares one
(the pigeonhole makes the search lossless, not just likely).

Items are partitioned by size (powers of two). Each partition has one cut-off,
the largest value in its items' sketches, and a least document size, the
smallest ``need``. A document's own sketch is all its hashes up to the largest
cut-off of the partitions that its size admits: a short document is never
looked up against long items, and however long a document is, its sketch misses
no item that it may hold.

Sketches meet in one equi-join on the hash value; the candidate pairs that
come out are verified on the shingles' words themselves.

An item's text is the unit, not its id: texts that share an id are sought each
on its own, and of those that a document contains the one with the greatest
containment is reported.

Defined results: an item of fewer than ``size`` words has one shingle, its
whole word sequence, and is contained where these words stand consecutively;
null and blank texts and items have no shingles and match nothing; a document
id that repeats is searched row by row and reported once per different text; a
null document or item id is reported as null; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.columns import let, runs, words
from ledgerflow.llm.common import keyed_rows, shared_table, unpacked

#: Rows of a side (tens of bytes each) that is broadcast rather than shuffled.
BROADCAST_ROWS = 500_000


def _bounded(side: DataFrame) -> DataFrame:
    """``side`` (a written table), to be broadcast if its counted rows are few."""
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def _hashes(text: Column, size: int) -> Column:
    """Distinct shingle hashes of a text."""
    of = lambda w: F.array_distinct(runs(w, size, F.xxhash64))
    return let(words(F.lower(text)), of)


def _spelt(text: Column, size: int) -> Column:
    """Distinct shingles of a text, as their words."""
    of = lambda w: F.array_distinct(runs(w, size, lambda *ws: F.concat_ws(" ", *ws)))
    return let(words(F.lower(text)), of)


def item_sets(items: DataFrame, size: int, percent: int, item_col: str, text_col: str) -> DataFrame:
    """(item, item_id, words, n_item, need, shingles, part, sketch) of every
    different text of an id, numbered by ``item``; ``words`` is the length of
    its shingles, which is less than ``size`` for shorter texts."""
    once = items.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")).distinct()
    w = words(F.lower(F.col("text")))
    spelt, hashed = F.array_join(w, " "), let(w, _short_hash)
    short = F.size(w) < size
    sets = once.where(F.size(w) > 0).select(
        F.monotonically_increasing_id().alias("item"), "item_id", F.least(F.size(w), F.lit(size)).alias("words"),
        F.when(short, F.array(spelt)).otherwise(_spelt(F.col("text"), size)).alias("shingles"),
        F.sort_array(F.when(short, F.array(hashed)).otherwise(_hashes(F.col("text"), size))).alias("h"),
    )
    n = F.size("h")
    need = F.ceil(n * percent / 100).cast("int")
    part = F.ceil(F.log2(n)).cast("int")
    return sets.select("item", "item_id", "words", n.alias("n_item"), need.alias("need"), "shingles", part.alias("part"), F.slice("h", F.lit(1), n - need + 1).alias("sketch"))


def _short_hash(w: Column) -> Column:
    """The hash of a whole word sequence, as ``runs`` makes it for that length."""
    hashes = [F.when(F.size(w) == n, F.xxhash64(*(F.get(w, F.lit(k)) for k in range(n)))) for n in range(1, 9)]
    return F.coalesce(*hashes)


def contained_items(
    docs: DataFrame, items: DataFrame, size: int = 5, percent: int = 75, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """(id, text_hash, item_id, n_item, n_shared, containment): the items that
    each document contains. ``size`` is 9 at most."""
    if not 1 <= size <= 9:
        raise ValueError("shingles have 1 to 9 words")
    sets = shared_table(item_sets(items, size, percent, item_col, text_col), "item-sets")
    # a row per power of two and shingle length
    parts = sets.groupBy("words", "part").agg(F.max(F.array_max("sketch")).alias("cut"), F.min("need").alias("least")).collect()
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    if not parts:
        empty = "text_hash long, n_item int, n_shared long, containment double"
        none = docs.sparkSession.createDataFrame([], empty)
        ids = F.lit(None).cast(docs.schema[id_col].dataType).alias(id_col), F.lit(None).cast(items.schema[item_col].dataType).alias("item_id")
        return none.select(ids[0], "text_hash", ids[1], "n_item", "n_shared", "containment")

    def sketch(length: int) -> Column:
        """The document's hashes of shingles of ``length`` words, up to the
        largest cut-off that its size admits."""
        of_length = [r for r in parts if r["words"] == length]

        def cut(h: Column) -> Column:
            cuts = [F.when(F.size(h) >= r["least"], F.lit(r["cut"])) for r in of_length]
            most = F.greatest(*cuts) if len(cuts) > 1 else cuts[0]
            return let(most, lambda c: F.filter(h, lambda x: x <= c))

        return let(_hashes(F.col("text"), length), cut)

    lengths = sorted({r["words"] for r in parts})
    looked = rows.select("id", "text_hash", F.explode(F.concat(*(sketch(n) for n in lengths)) if len(lengths) > 1 else sketch(lengths[0])).alias("hash"))
    entries = shared_table(sets.select("item", F.explode("sketch").alias("hash")), "item-entries")
    pairs = shared_table(looked.join(_bounded(entries), "hash").select("id", "text_hash", "item").distinct(), "candidates")

    # a candidate pair is a row, with the item's shingles beside the document's
    # text: no shingle is a join key, however frequent it is
    few = _bounded(pairs.select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), "item"))
    found = rows.join(few, rows["id"].eqNullSafe(few["_id"]) & (rows["text_hash"] == few["_hash"])).join(sets.drop("part", "sketch"), "item")
    lengths = [n for n in lengths if n < size]
    held = _spelt(F.col("text"), size)
    for n in lengths:
        held = F.when(F.col("words") == n, _spelt(F.col("text"), n)).otherwise(held)
    shared = F.size(F.array_intersect(held, F.col("shingles"))).cast("long")
    counts = found.select("id", "text_hash", "item_id", "n_item", "need", shared.alias("n_shared")).where("n_shared >= need")
    told = counts.select("id", "text_hash", "item_id", F.struct((F.col("n_shared") / F.col("n_item")).alias("containment"), "n_item", "n_shared").alias("best"))
    best = told.groupBy("id", "text_hash", "item_id").agg(F.max("best").alias("best"))
    return best.select(F.col("id").alias(id_col), "text_hash", "item_id", "best.n_item", "best.n_shared", "best.containment")


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = 5, percent: int = 75, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that contain an item."""
    bad = contained_items(docs, items, size, percent, id_col, item_col, text_col).select(F.col(id_col).cast("long").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    bad = _bounded(shared_table(bad, "contaminated"))
    rows = keyed_rows(docs, id_col, text_col)
    return unpacked(rows.join(bad, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left_anti"), docs.columns)
