"""Native validity predicates (U1): no Python worker, no row-at-a-time UDF.

Brazilian company tax id (CNPJ): 14 digits, the last two are mod-11 check
digits. Punctuation ``. / -`` is allowed and ignored; any other character
makes the id invalid; ids made of one repeated digit are invalid; NULL is
invalid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the public CNPJ algorithm: weights of the first check digit
# (over digits 1-12) and of the second (over digits 1-13).
CNPJ_WEIGHTS_1 = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
CNPJ_WEIGHTS_2 = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)


def digits_only(c: Column | str, allowed_punctuation: str = "./-") -> Column:
    """Remove the allowed punctuation characters."""
    c = F.col(c) if isinstance(c, str) else c
    return F.translate(c, allowed_punctuation, "")


def _digit(num: Column, pos: int) -> Column:
    """Digit at 1-based position ``pos`` of 14, in long arithmetic."""
    return F.call_function("div", num, F.lit(10 ** (14 - pos)).cast("long")) % F.lit(10).cast("long")


def _weighted(num: Column, weights: tuple[int, ...]) -> Column:
    total = None
    for pos, w in enumerate(weights, start=1):
        term = _digit(num, pos) * F.lit(w).cast("long")
        total = term if total is None else total + term
    return total


def _check_digit(total: Column) -> Column:
    r = total % F.lit(11).cast("long")
    return F.when(r < 2, F.lit(0).cast("long")).otherwise(F.lit(11).cast("long") - r)


def _verdict(raw: Column, digits: Column, num: Column, sum1: Column, sum2: Column, reject_repeated: bool) -> Column:
    # only digits and . / - in the raw value, and 14 left after stripping the
    # punctuation: then those 14 are digits
    shape_ok = (F.length(F.translate(raw, "0123456789./-", "")) == 0) & (F.length(digits) == 14)
    ok = (_check_digit(sum1) == _digit(num, 13)) & (_check_digit(sum2) == _digit(num, 14))
    if reject_repeated:
        ok = ok & (digits != F.repeat(F.substring(digits, 1, 1), 14))
    return F.coalesce(F.when(shape_ok, ok).otherwise(F.lit(False)), F.lit(False))


def cnpj_is_valid(c: Column | str, reject_repeated: bool = True) -> Column:
    """Boolean Column: true only for a well-formed CNPJ with correct check digits.

    Never NULL: a NULL input gives false. Input with characters other than
    digits and ``. / -`` gives false. Self-contained; on large frames prefer
    ``with_cnpj_valid``, which strips and parses once.
    """
    raw = F.col(c) if isinstance(c, str) else c
    digits = digits_only(raw)
    num = digits.try_cast("long")
    return _verdict(raw, digits, num, _weighted(num, CNPJ_WEIGHTS_1), _weighted(num, CNPJ_WEIGHTS_2), reject_repeated)


def with_cnpj_valid(df: DataFrame, column: str, out: str, reject_repeated: bool = True) -> DataFrame:
    """``df`` plus boolean ``out`` = CNPJ validity of ``column``.

    Three projections, each kept separate by Catalyst because its outputs
    are read several times (non-trivial expressions are not inlined into
    several places): digits and their numeric value → the two weighted
    sums → the verdict.
    """
    dg, num, s1, s2 = (f"__lf_{k}_{out}" for k in ("dg", "num", "s1", "s2"))
    step1 = df.withColumn(dg, digits_only(column)).withColumn(num, F.col(dg).try_cast("long"))
    step2 = step1.withColumn(s1, _weighted(F.col(num), CNPJ_WEIGHTS_1)).withColumn(s2, _weighted(F.col(num), CNPJ_WEIGHTS_2))
    verdict = _verdict(F.col(column), F.col(dg), F.col(num), F.col(s1), F.col(s2), reject_repeated)
    return step2.withColumn(out, verdict).drop(dg, num, s1, s2)
