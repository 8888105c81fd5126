"""Vector codes by product quantisation over a GNAT (operator 11).

Vectors are cut into equal parts, and every part position has a codebook of at
most ``entries`` entries that a few rounds of integer k-means move. The entry
nearest to a part is found in a geometric near-neighbour access tree over the
codebook: a node has split entries, every other entry of the node belongs to
the nearest split's subtree, and for each pair (split, subtree) the tree keeps
the least and greatest distance from the split to the subtree's entries. By
the triangle inequality a query that lies d from the split is at least
``d - greatest`` and ``least - d`` from every entry of the subtree; where one
split's bound is strictly above the distance already found, the whole
subtree goes.

Ranges and query distances are square roots in floating point, so the bounds
are rounded outwards (``_SLACK``) and eliminate only what is surely farther;
whatever remains is compared by exact integer squared distances, where ties go
to the lower index. The result is that of a full search. All queries of an
Arrow batch walk the tree together.

A round is one pass over the vectors: each task adds up its parts by entry, and
Spark adds up the tasks' sums, one row a task and entry. Only the sums
(``parts * entries`` rows, whatever the input) reach the driver, which makes the
next codebooks.

Defined results: rows whose vector is null or holds null or non-finite
components are dropped, as are rows whose vector is not as long as most are
(ties: the longer length); if the length is no multiple of ``parts``, vectors
are filled up with zeros; null ids come after all others, rows with equal ids
are ordered by their vectors, then labels; fewer rows than ``entries`` make a
smaller codebook; an empty table gives no rows; other columns are ignored.
Distances must fit into 64 bits, so that they are exact: for n components the
integer ones must be below sqrt(2**61 / n) (for 64 components that is 185,000
at the scale of 1,024); larger ones raise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import shared_table, ship

#: Entries from which a node of the tree is split, and splits of a node.
LEAF, SPLITS = 16, 16
#: Outward rounding of distances: above the error of a double square root.
_SLACK = 1e-12
#: Distinct labels up to which their sums are broadcast.
BROADCAST_LABELS = 100_000
_SALTS = 32


def _kind(most: int, width: int) -> type:
    """Doubles where every step of a squared distance is exact in them, which
    the integers of usual vectors are; else 64-bit integers."""
    return np.float64 if 4 * most * most * max(1, width) < 1 << 53 else np.int64


def _squared(a: np.ndarray, b: np.ndarray, a2: np.ndarray, b2: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to those of ``b``, given
    their squared lengths."""
    return a2[:, None] + b2[None, :] - 2 * (a @ b.T)


class _Search:
    """Queries on their walk through a tree, with the best found so far."""

    def __init__(self, queries: np.ndarray, entries: np.ndarray) -> None:
        most = max(int(np.abs(queries).max(initial=0)), int(np.abs(entries).max(initial=0)))
        kind = _kind(most, queries.shape[1])
        self.queries, self.entries = queries.astype(kind), entries.astype(kind)
        self.q2, self.e2 = ((x * x).sum(axis=1) for x in (self.queries, self.entries))
        self.best = np.full(len(queries), np.finfo(kind).max if kind is np.float64 else np.iinfo(kind).max, kind)
        self.index = np.full(len(queries), len(entries))

    def offer(self, rows: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Compare ``rows`` of the queries with the entries ``which`` (in
        ascending order), exactly; returns the squared distances."""
        d = _squared(self.queries[rows], self.entries[which], self.q2[rows], self.e2[which])
        k = d.argmin(axis=1)  # the lowest index of the nearest
        found, name = d[np.arange(len(rows)), k], which[k]
        best, index = self.best[rows], self.index[rows]
        better = (found < best) | (found == best) & (name < index)
        self.best[rows[better]], self.index[rows[better]] = found[better], name[better]
        return d


@dataclass
class Gnat:
    """A node over the rows ``members`` of ``entries``."""

    entries: np.ndarray
    members: np.ndarray
    splits: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    children: list[Gnat | None] = field(default_factory=list)
    least: np.ndarray | None = None  # [split, subtree] distances, rounded down
    greatest: np.ndarray | None = None  # ... rounded up

    @classmethod
    def build(cls, entries: np.ndarray, members: np.ndarray | None = None) -> Gnat:
        members = np.arange(len(entries)) if members is None else members
        node = cls(entries, members)
        if len(members) <= LEAF:
            return node
        s = _Search(entries[members], entries[members])
        d = _squared(s.queries, s.entries, s.q2, s.e2)
        chosen = [0]  # then always the entry farthest from those chosen
        near = d[0].copy()
        while len(chosen) < SPLITS and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, d[chosen[-1]])
        if len(chosen) < 2:  # equal entries alone
            return node
        chosen.sort()
        home = d[:, chosen].argmin(axis=1)
        home[chosen] = np.arange(len(chosen))
        real = np.sqrt(d[chosen].astype(np.float64))
        node.splits = members[chosen]
        node.least = np.zeros((len(chosen), len(chosen)))
        node.greatest = np.zeros((len(chosen), len(chosen)))
        rest = np.ones(len(members), bool)
        rest[chosen] = False
        for j in range(len(chosen)):
            mine = (home == j) & rest
            node.children.append(cls.build(entries, members[mine]) if mine.any() else None)
            if mine.any():
                node.least[:, j] = real[:, mine].min(axis=1) * (1 - _SLACK)
                node.greatest[:, j] = real[:, mine].max(axis=1) * (1 + _SLACK)
        return node

    def _walk(self, s: _Search, rows: np.ndarray) -> None:
        if not self.children:
            s.offer(rows, self.members)
            return
        d = s.offer(rows, self.splits)
        real = np.sqrt(d, dtype=np.float64)
        low, high = real * (1 - _SLACK), real * (1 + _SLACK)
        # the bound of every subtree: the largest that any split gives
        bound = np.zeros((len(self.children), len(rows)))
        for i in range(len(self.splits)):
            for j, child in enumerate(self.children):
                if child is not None:
                    np.maximum(bound[j], low[:, i] - self.greatest[i, j], out=bound[j])
                    np.maximum(bound[j], self.least[i, j] - high[:, i], out=bound[j])
        home = d.argmin(axis=1)
        # the nearest split's subtree first: it tightens the best distance
        for first in (True, False):
            for j, child in enumerate(self.children):
                if child is None:
                    continue
                todo = np.flatnonzero((home == j) if first else (home != j))
                todo = todo[bound[j][todo] <= np.sqrt(s.best[rows[todo]], dtype=np.float64) * (1 + _SLACK)]
                if len(todo):
                    child._walk(s, rows[todo])

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each query's nearest entry, and its squared distance."""
        s = _Search(queries, self.entries)
        if len(queries):
            self._walk(s, np.arange(len(queries)))
        return s.index, s.best.astype(np.int64)


def _integers(batches: Iterator[pa.RecordBatch], scale: int, length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column("vector")
        x = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), -1)
        x = np.floor(x * scale)
        if 4 * np.abs(x).max(initial=0) ** 2 * length >= 2.0**63:
            raise ValueError(f"a component is {np.abs(x).max() / scale:g}: the distances of so large components are not exact")
        out = np.zeros((len(batch), length), np.int32)
        out[:, : x.shape[1]] = x
        packed = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(np.arange(len(batch) + 1, dtype=np.int32) * (4 * length)), pa.py_buffer(out.tobytes())])
        yield batch.drop_columns(["vector"]).append_column("x", packed)


def integer_vectors(vectors: DataFrame, parts: int, scale: int, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, int]:
    """(id, label, x) of the kept rows, written: ``x`` holds the components as
    little-endian 32-bit integers; and their number."""
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vector").isNotNull() & finite)
    # few lengths, whatever the number of rows: the most frequent one is one row
    usual = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    size = usual.n if usual else 0
    length = -(-size // parts) * parts
    schema = T.StructType().add("id", rows.schema["id"].dataType).add("label", rows.schema["label"].dataType).add("x", "binary")
    packed = rows.where(F.size("vector") == size).mapInArrow(lambda batches: _integers(batches, scale, length), schema)
    return shared_table(packed, "integer-vectors"), length


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    raw = np.frombuffer(column.buffers()[2] or b"", np.int32) if length else np.zeros(0, np.int32)
    start = column.offset * length
    return raw[start : start + len(column) * length].reshape(len(column), length).astype(np.int64)


def _assigned(x: np.ndarray, trees: list[Gnat]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each part position: the parts, their entries and squared distances."""
    width = x.shape[1] // len(trees)
    for p, tree in enumerate(trees):
        part = x[:, p * width : (p + 1) * width]
        yield part, *tree.nearest(part)


def _sums(codebooks: list[np.ndarray], length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat.build(c) for c in codebooks]
        entries, width = codebooks[0].shape
        total = np.zeros((len(trees), entries, width), np.int64)
        count = np.zeros((len(trees), entries), np.int64)
        for batch in batches:
            for p, (part, entry, _) in enumerate(_assigned(_matrix(batch.column("x"), length), trees)):
                np.add.at(total[p], entry, part)
                count[p] += np.bincount(entry, minlength=entries)
        part, entry = np.nonzero(count)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]), pa.array(list(total[part, entry]), pa.list_(pa.int64()))],
                names=["part", "entry", "n", "total"],
            )

    return run


def first_codebooks(rows: DataFrame, length: int, parts: int, entries: int) -> list[np.ndarray]:
    """The parts of the ``entries`` rows with the smallest ids (at most so many
    reach the driver)."""
    first = rows.orderBy(F.asc_nulls_last("id"), "x", F.asc_nulls_last("label")).limit(entries).select("x").collect()
    x = np.array([np.frombuffer(r.x, np.int32) for r in first], np.int64).reshape(len(first), length)
    return list(np.hsplit(x, parts)) if length else [x] * parts


def moved(rows: DataFrame, codebooks: list[np.ndarray], length: int) -> list[np.ndarray]:
    """One round: every used entry becomes the floor of the mean of its parts."""
    width = codebooks[0].shape[1]
    sums = rows.select("x").mapInArrow(_sums(codebooks, length), "part int, entry int, n long, total array<long>")
    sums = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[k]) for k in range(width)]).alias("total"))
    out = [c.copy() for c in codebooks]
    for r in sums.collect():  # parts * entries rows at most
        out[r.part][r.entry] = np.array(r.total, np.int64) // r.n  # floors go down
    return out


def train_codebooks(rows: DataFrame, length: int, parts: int = 4, entries: int = 256, n_rounds: int = 4) -> list[np.ndarray]:
    codebooks = first_codebooks(rows, length, parts, entries)
    for _ in range(n_rounds if len(codebooks[0]) else 0):
        codebooks = moved(rows, codebooks, length)
    return codebooks


def codebooks_sha256(codebooks: list[np.ndarray]) -> str:
    """Of all components as decimal integers, by part, entry and position."""
    return hashlib.sha256(",".join(str(v) for c in codebooks for v in c.ravel().tolist()).encode()).hexdigest()


def _codes(codebooks: list[np.ndarray], length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat.build(c) for c in codebooks]
        for batch in batches:
            found = list(_assigned(_matrix(batch.column("x"), length), trees))
            code = np.stack([entry for _, entry, _ in found], axis=1).astype(np.uint8 if len(codebooks[0]) <= 256 else np.uint16)
            error = sum(d for _, _, d in found)
            yield batch.drop_columns(["x"]).append_column("code", pa.array([c.tobytes() for c in code], pa.binary())).append_column("error", pa.array(error, pa.int64()))

    return run


def encode(rows: DataFrame, codebooks: list[np.ndarray], length: int) -> DataFrame:
    """(id, label, code, error): ``code`` one byte a part (two, from 257
    entries on), ``error`` the squared distances to the entries, summed."""
    schema = T.StructType().add("id", rows.schema["id"].dataType).add("label", rows.schema["label"].dataType).add("code", "binary").add("error", "long")
    return rows.mapInArrow(_codes(codebooks, length), schema)


def _with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of equal labels (nulls together) summed up
    before they meet the rows; a label with very many rows is never one group."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    if sums.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums.withColumnRenamed("label", "of"))
        return coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    salt = F.pmod(F.xxhash64("id", "code"), F.lit(_SALTS))
    sums = sums.select(F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("of_salt"))
    salted = coded.withColumn("salt", salt)
    return salted.join(sums, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("of_salt")), "left").drop("of", "of_salt", "salt")


def compress_vectors(
    vectors: DataFrame,
    parts: int = 4,
    entries: int = 256,
    n_rounds: int = 4,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """Per kept row: its id, label, code, error and label_error; and the
    codebooks, one array (entries, components) a part."""
    ship(vectors.sparkSession)
    rows, length = integer_vectors(vectors, parts, scale, id_col, vector_col, label_col)
    codebooks = train_codebooks(rows, length, parts, entries, n_rounds)
    coded = encode(rows, codebooks, length) if len(codebooks[0]) else rows.select("id", "label", F.col("x").alias("code"), F.lit(0).cast("long").alias("error"))
    coded = _with_label_error(shared_table(coded, "vector-codes"))
    return coded.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error", "label_error"), codebooks
