"""Declarative data-quality rules and the quarantine split (D1, D1a-e).

``validate(df, rules)`` runs every rule in one pass:

* the input is grouped once by all its columns (``count`` per distinct row).
  Both outputs are distinct rows, so nothing is lost, and the duplicate rule
  is just ``n > 1``: no row id, no self join. The aggregation is partial
  (map-side), so a row repeated billions of times reaches the shuffle at
  most once per input partition;
* row rules are boolean Columns over the grouped rows;
* lookup rules are left joins of the grouped rows to the distinct key list
  of a dimension (see ``operators.joins``), adding a hit flag;
* the reasons text is ``concat_ws(', ', when(fail_i, label_i) ...)`` in rule
  order, so it is deterministic.

accepted = rows where no *blocking* rule fired; rejected = rows where any
rule fired (a duplicated but otherwise clean row is in both, like the
reference's non-blocking duplicate rule).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.checks import cnpj_is_valid, with_cnpj_valid
from ledgerflow.functions.clean import concat_labels
from ledgerflow.operators.bitmaps import mark_members, stage_bitmaps
from ledgerflow.operators.joins import collated, lookup_join
from ledgerflow.session import remove_path

ColumnOrName = Column | str


@dataclass(frozen=True)
class Rule:
    """One rule. ``fails`` builds the failing predicate over the grouped rows.

    kind: "row" (``fails`` given), "frame" (``add_ok`` adds a pass column
    through its own projections, e.g. the check-digit rule), "lookup"
    (``dim``/``dim_key``/``key`` given), or "duplicate".
    """

    label: str
    kind: str = "row"
    fails: Callable[[DataFrame], Column] | None = None
    blocking: bool = True
    key: Callable[[DataFrame], Column] | None = None
    dim: DataFrame | None = None
    dim_key: ColumnOrName | None = None
    broadcast: bool | None = None  # see operators.joins.lookup_join
    # "frame" rules add their own boolean *pass* column: (df, name) -> df
    add_ok: Callable[[DataFrame, str], DataFrame] | None = None
    salt_hot_keys: int | None = None
    collation: str | None = None
    bitmap: bool = False  # test membership by bitmaps of integer keys


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rule_expr(fails: Column | Callable[[DataFrame], Column], label: str, blocking: bool = True) -> Rule:
    """Generic row rule: fires where ``fails`` is true (NULL counts as false)."""
    fn = fails if callable(fails) and not isinstance(fails, Column) else (lambda df, c=fails: c)
    return Rule(label=label, kind="row", fails=fn, blocking=blocking)


def rule_not_null(columns: Iterable[str] | None = None, label: str = "null column(s)", *, exclude: Iterable[str] = (), blocking: bool = True) -> Rule:
    """Fires when any of ``columns`` (default: all columns but ``exclude``) is NULL."""
    cols = None if columns is None else list(columns)
    excl = set(exclude)

    def fails(df: DataFrame) -> Column:
        names = [c for c in (cols if cols is not None else df.columns) if c not in excl and not c.startswith("__lf_")]
        out = F.lit(False)
        for name in names:
            out = out | F.col(name).isNull()
        return out

    return Rule(label=label, kind="row", fails=fails, blocking=blocking)


def rule_in_domain(column: ColumnOrName, values: Iterable, label: str, *, blocking: bool = True) -> Rule:
    """Fires when the value is set but outside ``values``.

    A NULL value does not fire this rule (the not-null rule covers it).
    """
    vals = list(values)

    def fails(df: DataFrame) -> Column:
        c = _col(column)
        return c.isNotNull() & ~c.isin(vals)

    return Rule(label=label, kind="row", fails=fails, blocking=blocking)


def rule_in_lookup(
    key: ColumnOrName | Callable[[DataFrame], Column],
    dim: DataFrame,
    dim_key: ColumnOrName,
    label: str,
    *,
    blocking: bool = True,
    broadcast: bool | None = None,
    salt_hot_keys: int | None = None,
    collation: str | None = None,
    bitmap: bool = False,
) -> Rule:
    """Fires when ``key`` has no match in ``dim[dim_key]``.

    ``key`` may be an expression, e.g. a parsed integer of a text column. A
    NULL or unparseable key has no match, so it fires. ``salt_hot_keys``
    spreads keys with that many distinct rows when the lookup shuffles.
    ``collation`` compares text keys as a Spark collation does.

    ``bitmap=True`` is for integer keys too many to broadcast as rows: the
    dimension becomes one bit a key (``operators.bitmaps``), written when the
    rules are run, and the checked rows are not shuffled as long as the bits
    fit a broadcast.
    """
    if bitmap and collation:
        raise ValueError("bitmap is for integer keys")
    if isinstance(key, (str, Column)):
        kf = lambda df, k=key: _col(k)
    else:
        kf = key
    return Rule(label=label, kind="lookup", key=kf, dim=dim, dim_key=dim_key, blocking=blocking,
                broadcast=broadcast, salt_hot_keys=salt_hot_keys, collation=collation, bitmap=bitmap)


def rule_check_digit(column: ColumnOrName, label: str, kind: str = "cnpj", *, blocking: bool = True) -> Rule:
    """Fires when the id fails its check digits (D1d). NULL fires."""
    if kind != "cnpj":
        raise ValueError(f"unknown check-digit scheme {kind!r}")
    if isinstance(column, str):
        return Rule(label=label, kind="frame", add_ok=lambda df, name: with_cnpj_valid(df, column, name), blocking=blocking)
    return Rule(label=label, kind="row", fails=lambda df: ~cnpj_is_valid(column), blocking=blocking)


def rule_duplicated(label: str = "duplicated", *, blocking: bool = False) -> Rule:
    """Fires for rows that occur more than once (D1e); non-blocking by default."""
    return Rule(label=label, kind="duplicate", blocking=blocking)


@dataclass
class Validation:
    """Result of ``validate``: lazily defined DataFrames over one annotated plan."""

    annotated: DataFrame
    columns: list[str]
    rules: list[Rule]
    count_col: str
    reasons_col: str

    seen: object | None = None  # plans.seen.SeenRows
    load: str | None = None
    staged: str | None = None  # the load's rows, written

    def _with(self, annotated: DataFrame) -> "Validation":
        return Validation(annotated, self.columns, self.rules, self.count_col, self.reasons_col, self.seen, self.load, self.staged)

    @property
    def is_accepted(self) -> Column:
        # a row that an earlier load had was judged there
        ok = ~F.col("__lf_blocked")
        return ok & (F.col("__lf_prior") == 0) if self.seen else ok

    @property
    def is_rejected(self) -> Column:
        # ... and becomes a duplicate with its second copy, not with each one
        fired = F.col("__lf_fired")
        return fired & (F.col("__lf_prior") <= 1) if self.seen else fired

    @property
    def accepted(self) -> DataFrame:
        return self.annotated.filter(self.is_accepted).select(*self.columns)

    @property
    def rejected(self) -> DataFrame:
        return self.annotated.filter(self.is_rejected).select(*self.columns, self.reasons_col)

    def record(self) -> None:
        """Keep the load's digests for later loads (with ``seen``), once its
        outputs are published. The written rows that the outputs come from are
        deleted then."""
        spark = self.annotated.sparkSession
        rows = spark.read.parquet(self.staged)
        self.seen.record(rows.select("__lf_d1", "__lf_d2", F.col(self.count_col).alias("n")), self.load)
        remove_path(spark, self.staged)

    def stats(self, written: str = "written", rejected: str = "rejected") -> DataFrame:
        """One row (written, rejected): accepted and rejected row counts, one pass (K8)."""
        return self.annotated.agg(
            F.count_if(self.is_accepted).alias(written),
            F.count_if(self.is_rejected).alias(rejected),
        )

    def rule_counts(self) -> DataFrame:
        """Rows (rule, failures): one aggregation over the annotated rows."""
        aggs = [F.count_if(F.col(f"__lf_fail{i}")).alias(f"r{i}") for i in range(len(self.rules))]
        one = self.annotated.agg(*aggs)
        pairs = ", ".join(f"'{r.label.replace(chr(39), chr(39) * 2)}', r{i}" for i, r in enumerate(self.rules))
        return one.selectExpr(f"stack({len(self.rules)}, {pairs}) AS (rule, failures)")

    def materialize(self, path: str) -> "Validation":
        """Write the annotated rows once (Parquet at ``path``, a shared folder)
        and return a Validation reading them back.

        Both outputs then come from a columnar scan instead of a second run
        of the grouping shuffle, and unlike a cache the written rows survive
        the loss of an executor.
        """
        self.annotated.write.mode("overwrite").parquet(path)
        back = self.annotated.sparkSession.read.parquet(path)
        return self._with(back)

    @contextmanager
    def persisted(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
        """Keep the annotated rows while both outputs are written, then release.

        Cached blocks lost with an executor are recomputed from lineage.
        """
        self.annotated = self.annotated.persist(level)
        try:
            yield self
        finally:
            self.annotated.unpersist()


def validate(
    df: DataFrame,
    rules: Sequence[Rule],
    *,
    columns: Sequence[str] | None = None,
    reasons_col: str = "inconsistencies",
    count_col: str = "__lf_n",
    sep: str = ", ",
    distinct: bool = True,
    carry: Sequence[str] = (),
    seen=None,
    load: str | None = None,
) -> Validation:
    """Run ``rules`` over ``df`` and split it into accepted / rejected rows.

    ``carry`` names columns that belong to a row (in the grouping too) but to
    no output; the annotated rows have them.

    ``seen`` (a ``plans.seen.SeenRows``) and the name of this ``load`` make the
    duplicate rule look at earlier loads too. Then all loads together accept
    each row once and report it as a duplicate once, as one load of everything
    would; call ``record`` when the outputs are published.

    ``distinct=False`` (only without a duplicate rule) keeps every input row
    instead of distinct rows: no aggregation, so the whole validation runs
    map-side without a shuffle (lookups against a broadcast dimension).
    """
    cols = list(columns or df.columns)
    base = df.select(*cols, *carry)
    staged = None
    if seen is not None and (load is None or not distinct):
        raise ValueError("seen rows need the name of the load and distinct=True")
    if distinct:
        # one shuffle: distinct rows with their multiplicity (partial aggregation)
        g = base.groupBy(*cols, *carry).agg(F.count(F.lit(1)).alias(count_col))
        if seen is not None:
            g, staged = seen.with_prior(g, load, "__lf_prior")
    else:
        if any(r.kind == "duplicate" for r in rules):
            raise ValueError("the duplicate rule needs distinct=True")
        g = base.withColumn(count_col, F.lit(1).cast("long"))
    fail_cols: list[Column] = []
    for i, rule in enumerate(rules):
        name = f"__lf_fail{i}"
        if rule.kind == "duplicate":
            copies = F.col(count_col) + F.col("__lf_prior") if seen is not None else F.col(count_col)
            g = g.withColumn(name, copies > 1)
        elif rule.kind == "row":
            g = g.withColumn(name, F.coalesce(rule.fails(g), F.lit(False)))
        elif rule.kind == "frame":
            g = rule.add_ok(g, name).withColumn(name, ~F.coalesce(F.col(name), F.lit(False)))
        elif rule.kind == "lookup" and rule.bitmap:
            bitmaps, fits = stage_bitmaps(rule.dim, _col(rule.dim_key))
            g = mark_members(g, rule.key(g), bitmaps, name, broadcast=fits or None).withColumn(name, ~F.col(name))
        elif rule.kind == "lookup":
            hit = f"__lf_hit{i}"
            dim_keys = rule.dim.select(collated(_col(rule.dim_key), rule.collation).alias("__lf_dk")).where(F.col("__lf_dk").isNotNull())
            dim_keys = dim_keys.distinct().withColumn(hit, F.lit(True))
            g = lookup_join(g, dim_keys, [rule.key(g)], ["__lf_dk"], "left", broadcast=rule.broadcast, salt_hot_keys=rule.salt_hot_keys, collation=rule.collation)
            g = g.withColumn(name, F.col(hit).isNull()).drop(hit)
        else:
            raise ValueError(f"unknown rule kind {rule.kind!r}")
        fail_cols.append(F.col(name))
    blocked = F.lit(False)
    fired = F.lit(False)
    for rule, fc in zip(rules, fail_cols):
        fired = fired | fc
        if rule.blocking:
            blocked = blocked | fc
    # A filter on the flag must stay above the rule projections, or Catalyst
    # pushes it down and re-inlines the rule expressions into it. With
    # grouping, ``count > 0`` (always true) ties the flag to the aggregate's
    # output. Without it, ``spark_partition_id() >= 0`` (always true, but
    # nondeterministic) makes the final projection one that filters are
    # never pushed through.
    fence = (F.col(count_col) > 0) if distinct else (F.spark_partition_id() >= 0)
    blocked = blocked & fence
    annotated = g.select(
        *cols,
        *carry,
        *(["__lf_d1", "__lf_d2", "__lf_prior"] if seen is not None else []),
        F.col(count_col),
        *[fc for fc in fail_cols],
        concat_labels([(fc, r.label) for fc, r in zip(fail_cols, rules)], sep).alias(reasons_col),
        blocked.alias("__lf_blocked"),
        fired.alias("__lf_fired"),
    )
    return Validation(annotated=annotated, columns=cols, rules=list(rules), count_col=count_col, reasons_col=reasons_col, seen=seen, load=load, staged=staged)
