"""Quality rules with robust multivariate outliers (operator 6), in DataFrame
operations only.

Five transformed statistics of each document form a vector. Per language and
source the minimum-covariance-determinant location and scatter are estimated by
concentration steps: start from medians and median absolute deviations, keep
the ``CORE`` share of the group's rows that lie nearest, take their mean and
covariance, and repeat; one reweighting step follows. A document whose squared
Mahalanobis distance exceeds the cut is rejected. Distances come from a
Cholesky factor written out as column expressions over the group's row of
estimates, so no matrix leaves the JVM.

Every step is one partial aggregation over the written vectors; a group that
holds a third of all rows is aggregated on the map side like any other, and
the few numbers per group are joined back (broadcast when counted to be few).
Groups of fewer than ``MIN_ROWS`` usable rows are pooled into one; if that is
still too small, its rows are judged by the base rules alone.

Defined results: null and empty texts have no words and fail the base rules;
a null language or source is a value of its own; repeated rows are judged (and
counted) each; a null id is passed through; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.columns import adjacent_sum, let, runs, words
from ledgerflow.llm.common import shared_table

#: The vector, and the least standard deviation that each part is taken to
#: have (many documents share a value exactly, most of all zero).
VECTOR = {"log_words": 0.3, "log_length": 0.05, "symbols": 0.4, "repeats": 0.15, "dup_lines": 0.15}
CORE = 0.75
STEPS = 4
MIN_ROWS = 60
#: Groups whose estimates (a few hundred bytes each) are broadcast.
BROADCAST_GROUPS = 50_000
# chi-square with five degrees of freedom: variance of the CORE share nearest
# the centre against all of it, the 0.975 quantile with its own share, and the
# rejection cut, the 1 - 1e-6 quantile
CORE_SHRINK = 0.5313 / 0.75
REWEIGHT, REWEIGHT_SHRINK = 12.83, 0.9240 / 0.975
CUT = 36.0
WINDOW = 8


def _repeat_words(w: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that the text has twice."""

    def covered(h: Column) -> Column:
        def at(pairs: Column) -> Column:
            same = lambda x, i, k: F.coalesce(F.get(pairs, i + k)["h"] == x["h"], F.lit(False))
            twice = F.filter(pairs, lambda x, i: same(x, i, -1) | same(x, i, 1))
            return let(F.sort_array(F.transform(twice, lambda x: x["i"])), lambda p: adjacent_sum(p, WINDOW))

        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(pairs, at))

    return let(runs(F.transform(w, lambda x: F.xxhash64(x)), WINDOW, F.xxhash64), covered)


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words) of every whole text; n_lines counts lines with a word."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = let(words(text), lambda w: F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), _repeat_words(w).alias("repeats")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dups")))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), of_words.alias("w"), of_lines.alias("l"), F.regexp_count(text, F.lit("[#*$%&|<>]")).alias("n_symbols")
    )
    long = {"n_words": "w.n", "word_chars": "w.chars", "n_symbols": "n_symbols", "n_lines": "l.n", "n_dup_lines": "l.dups", "n_repeat_words": "w.repeats"}
    return rows.select("id", "lang", "source", *(F.col(c).cast("long").alias(k) for k, c in long.items()))


def _vector() -> dict[str, Column]:
    n = F.greatest("n_words", F.lit(1))
    share = lambda part, whole: F.asin(F.sqrt(F.col(part) / F.greatest(F.col(whole), F.lit(1))))
    made = [F.log(n), F.log(F.greatest("word_chars", F.lit(1)) / n), F.log1p(100 * F.col("n_symbols") / F.greatest("word_chars", F.lit(1))), share("n_repeat_words", "n_words"), share("n_dup_lines", "n_lines")]
    return dict(zip(VECTOR, made))


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns, F.lit(0.0))


def _estimates(rows: DataFrame, weight: Column, shrink: float) -> DataFrame:
    """Per group: means and the Cholesky factor of the covariance of the rows
    where ``weight`` holds, scaled to all of the group."""
    names = list(VECTOR)
    moments = [F.avg(F.when(weight, F.col(a))).alias(f"m_{a}") for a in names]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[: i + 1]]
    moments += [F.covar_pop(F.when(weight, F.col(a)), F.when(weight, F.col(b))).alias(f"c_{a}_{b}") for a, b in pairs]
    out = rows.groupBy("g").agg(*moments)
    factor: dict[tuple[str, str], Column] = {}
    for i, a in enumerate(names):  # each entry is a column, so later ones can name it
        for b in names[: i + 1]:
            rest = F.col(f"c_{a}_{b}") / shrink - _sum([factor[a, k] * factor[b, k] for k in names[: names.index(b)]])
            value = F.sqrt(F.greatest(rest + VECTOR[a] ** 2, F.lit(VECTOR[a] ** 2))) if a == b else rest / factor[b, b]
            out = out.withColumn(f"l_{a}_{b}", value)
            factor[a, b] = F.col(f"l_{a}_{b}")
    return out.drop(*(f"c_{a}_{b}" for a, b in pairs))


def _distance(rows: DataFrame, estimates: DataFrame, few: bool) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance ``d2`` to their group."""
    names = list(VECTOR)
    out = rows.join(F.broadcast(estimates) if few else estimates, "g", "left")
    solved: list[str] = []
    for i, a in enumerate(names):  # forward substitution
        z = (F.col(a) - F.col(f"m_{a}") - _sum([F.col(f"l_{a}_{b}") * F.col(f"z_{b}") for b in names[:i]])) / F.col(f"l_{a}_{a}")
        out = out.withColumn(f"z_{a}", z)
        solved.append(f"z_{a}")
    return out.withColumn("d2", _sum([F.col(z) * F.col(z) for z in solved])).select(*rows.columns, "d2")


def judge(statistics: DataFrame) -> DataFrame:
    """``text_statistics`` rows with base_failed, d2 (null where there is no
    estimate) and kept."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    statistics = shared_table(statistics, "statistics")  # read for the group sizes too
    rows = statistics.withColumn("base_failed", failed).withColumns(_vector())
    usable = rows.where(~F.col("base_failed"))
    key = F.concat_ws("|", *(F.coalesce(F.concat(F.lit("="), c), F.lit("?")) for c in ("lang", "source")))
    counts = usable.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    counts = shared_table(counts, "group-sizes")
    few = counts.count() <= BROADCAST_GROUPS
    sized = counts.select("key", F.when(F.col("rows") >= MIN_ROWS, F.col("key")).otherwise(F.lit("*")).alias("g"))
    sized = sized.withColumnRenamed("key", "_key")
    rows = rows.withColumn("_key", key).join(F.broadcast(sized) if few else sized, "_key", "left").drop("_key")
    rows = shared_table(rows, "vectors")
    usable = rows.where(~F.col("base_failed")).select("g", *VECTOR)

    # start: medians and median absolute deviations, no correlation
    middle = usable.groupBy("g").agg(*(F.percentile_approx(a, 0.5).alias(f"m_{a}") for a in VECTOR))
    spread = usable.join(F.broadcast(middle) if few else middle, "g").groupBy("g").agg(*(F.percentile_approx(F.abs(F.col(a) - F.col(f"m_{a}")), 0.5).alias(f"s_{a}") for a in VECTOR))
    diagonal = {f"l_{a}_{a}": F.sqrt((1.4826 * F.col(f"s_{a}")) ** 2 + floor**2) for a, floor in VECTOR.items()}
    zeros = {f"l_{a}_{b}": F.lit(0.0) for i, a in enumerate(VECTOR) for b in list(VECTOR)[:i]}
    estimates = middle.join(spread, "g").withColumns(diagonal | zeros).drop(*(f"s_{a}" for a in VECTOR))
    for _ in range(STEPS):
        estimates = shared_table(estimates, "estimates")
        near = _distance(usable, estimates, few)
        edge = near.groupBy("g").agg(F.percentile_approx("d2", CORE).alias("edge"))
        near = near.join(F.broadcast(edge) if few else edge, "g")
        estimates = _estimates(near, F.col("d2") <= F.col("edge"), CORE_SHRINK)
    estimates = shared_table(estimates, "estimates")
    estimates = shared_table(_estimates(_distance(usable, estimates, few), F.col("d2") <= REWEIGHT, REWEIGHT_SHRINK), "estimates")
    enough = usable.groupBy("g").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= MIN_ROWS).select("g")
    judged = _distance(rows, estimates.join(enough, "g", "left_semi"), few)
    kept = ~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= CUT)
    return judged.select(*statistics.columns, "base_failed", "d2", kept.alias("kept"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Statistics and verdict of every document."""
    return judge(text_statistics(docs, id_col, text_col, lang_col, source_col)).withColumnRenamed("id", id_col)
