"""Lookup joins with skew-safe NULL keys.

``lookup_join(left, right, ...)`` is one join in one pass over each side:

1. **Broadcasting is Catalyst's choice** from the optimizer's sizes and, at
   runtime, AQE's measured shuffle bytes
   (``spark.sql.autoBroadcastJoinThreshold``, set in ``ledgerflow.session``).
   No side is counted or probed beforehand. ``broadcast=True`` is the caller's
   statement that the right side is small; ``broadcast=False`` forbids it.
2. Hot non-NULL keys on the streamed side are split at runtime by AQE's
   skew-join handling, which supports inner, left outer, left semi and left
   anti joins.
3. **NULL keys never match**, but in a shuffle join they would all hash to
   one partition. The key of the preserved side therefore carries a salt: 0
   for a set key (as on the right side), a running number for a row with a
   NULL in its key. Such rows still match nothing and stay spread, however
   many and however alike they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hot keys (``salt_hot_keys``) that may be broadcast.
MAX_HOT_KEYS = 2_000_000
_NULL_SALTS = 1 << 20


def any_null(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNull()
    return out


def collated(key: Column, collation: str | None) -> Column:
    """The text key under a Spark collation (e.g. ``UNICODE_CI_RTRIM``): equality,
    grouping and joins then go by it."""
    return F.collate(key, collation) if collation else key


def null_salt(keys: Sequence[str]) -> Column:
    """0 for rows whose key is set, else a number that spreads the rows."""
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(_NULL_SALTS)) + 1
    return F.when(any_null(keys), spread).otherwise(F.lit(0).cast("long"))


def zero_salt(keys: Sequence[str]) -> Column:
    """0, but as a column: a literal would be folded out of the join key and
    the salt with it."""
    return F.pmod(F.xxhash64(*keys), F.lit(1).cast("long"))


_HOW = {"left_outer": "left", "leftouter": "left", "anti": "left_anti", "leftanti": "left_anti",
        "semi": "left_semi", "leftsemi": "left_semi"}


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str | Column],
    right_on: Sequence[str],
    how: str = "inner",
    *,
    broadcast: bool | None = None,
    salt_hot_keys: int | None = None,
    salt_buckets: int = 64,
    collation: str | None = None,
) -> DataFrame:
    """Equi-join ``left`` to ``right`` where ``left_on[i] == right[right_on[i]]``.

    ``left_on`` may hold expressions over ``left`` (e.g. ``upper(col)`` or a
    parsed key); ``right_on`` names columns of ``right``. ``how`` is one of
    inner, left, left_semi, left_anti. The result has the columns of
    ``left`` followed, for inner/left, by the non-key columns of ``right``
    (which must not clash with ``left``'s). ``broadcast`` as in the module
    docstring.

    ``collation`` compares text keys as a Spark collation does; a right side
    with one row per key must then be so under the collation.

    Keys are joined under fresh internal names, so self-joins (``right``
    derived from ``left``) are unambiguous.

    ``salt_hot_keys=n`` (for joins that AQE cannot split, such as one feeding
    an aggregation on the same key): keys with at least ``n`` rows on the left
    are found with one partial aggregation and, counted to be few, broadcast.
    Their left rows are dealt over ``salt_buckets`` salts row by row (identical
    rows too) and their right rows are replicated once per salt.
    """
    how = _HOW.get(how.lower(), how.lower())
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported lookup join type {how!r}")
    if len(left_on) != len(right_on) or not right_on:
        raise ValueError("left_on and right_on must have the same, non-zero length")
    extra = [c for c in right.columns if c not in right_on] if how in ("inner", "left") else []
    clash = set(extra) & set(left.columns)
    if clash:
        raise ValueError(f"lookup columns clash with the left side: {sorted(clash)}")
    lk = [f"__lf_lk{i}" for i in range(len(left_on))]
    rk = [f"__lf_rk{i}" for i in range(len(right_on))]
    l = left.select("*", *[(F.col(a) if isinstance(a, str) else a).alias(n) for a, n in zip(left_on, lk)])
    r = right.select(*[F.col(b).alias(n) for b, n in zip(right_on, rk)], *extra)
    if collation:
        text = {n for n, t in l.select(*lk).dtypes if t.startswith("string")}
        l = l.withColumns({n: collated(F.col(n), collation) for n in lk if n in text})
        r = r.withColumns({m: collated(F.col(m), collation) for n, m in zip(lk, rk) if n in text})
    pairs = list(zip(lk, rk))

    def on(ps) -> Column:
        cond = None
        for a, b in ps:
            c = F.col(a) == F.col(b)
            cond = c if cond is None else (cond & c)
        return cond

    if broadcast:
        return l.join(F.broadcast(r), on(pairs), how).select(*left.columns, *extra)
    salt = "__lf_salt"
    if how in ("left", "left_anti") or salt_hot_keys:
        l, r = l.withColumn(salt, null_salt(lk)), r.withColumn(salt + "_r", zero_salt(rk))
        if salt_hot_keys:
            l, r = _salt_hot(l, r, lk, rk, salt, salt_hot_keys, salt_buckets)
        pairs.append((salt, salt + "_r"))
    if broadcast is False:
        r = r.hint("merge")
    return l.join(r, on(pairs), how).select(*left.columns, *extra)


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int) -> DataFrame:
    """Non-NULL key values with at least ``min_rows`` rows (partial aggregation)."""
    set_all = F.lit(True)
    for k in keys:
        set_all = set_all & F.col(k).isNotNull()
    return df.where(set_all).groupBy(*keys).agg(F.count(F.lit(1)).alias("__lf_cnt")).where(F.col("__lf_cnt") >= min_rows).select(*keys)


def _salt_hot(l: DataFrame, r: DataFrame, lk: list[str], rk: list[str], spread: str, min_rows: int, buckets: int):
    hot = hot_keys(l, lk, min_rows)
    if hot.count() > MAX_HOT_KEYS:
        raise ValueError(f"salt_hot_keys={min_rows} selects too many keys to broadcast; raise it")
    hot_l = F.broadcast(hot.withColumn("__lf_hot", F.lit(True)))
    hot_r = F.broadcast(hot.select(*[F.col(a).alias(b) for a, b in zip(lk, rk)]).withColumn("__lf_hot", F.lit(True)))
    lsalt = F.pmod(F.monotonically_increasing_id(), F.lit(buckets))
    l = (
        l.join(hot_l, list(lk), "left")
        .withColumn(spread, F.when(F.col("__lf_hot"), -1 - lsalt).otherwise(F.col(spread)))
        .drop("__lf_hot")
    )
    salts = F.when(F.col("__lf_hot"), F.sequence(F.lit(-buckets).cast("long"), F.lit(-1).cast("long"))).otherwise(F.array(F.col(spread + "_r")))
    r = (
        r.join(hot_r, list(rk), "left")
        .withColumn(spread + "_r", F.explode(salts))
        .drop("__lf_hot")
    )
    return l, r


def subtract_by_key(df: DataFrame, other: DataFrame, keys: Sequence[str], **kw) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other`` (J1, a left anti join)."""
    return lookup_join(df, other.select(*keys), list(keys), list(keys), "left_anti", **kw)
