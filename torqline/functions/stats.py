"""p-values as column expressions, so a verdict never leaves the plan."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_KS_TERMS = 100
_ERF_TERMS = 150


def _series(terms: int, start: Column, advance) -> Column:
    """Sum of a series whose next term comes from the previous one: ``advance(term, k)``."""
    state = F.struct(start.alias("term"), start.alias("total"))

    def step(acc, k):
        term = advance(acc["term"], k)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(terms)), state, step, lambda acc: acc["total"])


def kolmogorov_p(distance: Column, n_ref: Column, n_cur: Column) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value."""
    n = n_ref.cast("double") * n_cur.cast("double") / (n_ref + n_cur).cast("double")
    scaled = n * distance * distance
    tail = F.aggregate(
        F.sequence(F.lit(1), F.lit(_KS_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(k * k * scaled * -2.0),
    )
    # Below this the alternating series has not converged and the p-value is 1 to 12 digits.
    return F.when(scaled < 0.04, F.lit(1.0)).otherwise(F.least(F.greatest(tail, F.lit(0.0)), F.lit(1.0)))


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0 (all-positive series of erf)."""
    first = x * F.exp(-x * x) * (2.0 / math.sqrt(math.pi))
    erf = _series(_ERF_TERMS, first, lambda term, k: term * x * x * 2.0 / (k * 2 + 1))
    return F.when(x > 6.0, F.lit(0.0)).otherwise(F.greatest(F.lit(1.0) - erf, F.lit(0.0)))


def normal_two_sided_p(z: Column) -> Column:
    return erfc(F.abs(z) / math.sqrt(2.0))


def chi2_p(statistic: Column, degrees: Column) -> Column:
    """Upper tail of the chi-squared distribution from its closed forms, for any degrees of freedom.

    Even degrees give a finite exponential sum, odd ones add the complementary error
    function. There are as many terms as the degrees ask for; they are built from logarithms, so that
    large statistics do not underflow.
    """
    half = statistic / 2.0
    odd = degrees % 2 == 1
    # Terms exp(-half) half^j / Gamma(j + 1) from j = 0 (even), or with j + 1/2 for j (odd), while j < degrees / 2.
    shift = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
    first = -half + shift * F.ln(half) - F.when(odd, F.lit(math.lgamma(1.5))).otherwise(F.lit(0.0))
    terms = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.ceil(degrees / 2.0), F.lit(1)).cast("int")),
        F.struct(first.alias("log"), F.lit(0.0).alias("total")),
        lambda acc, k: F.struct(
            (acc["log"] + F.ln(half) - F.ln(k + shift)).alias("log"),
            # The k-th step adds term k - 1, of which odd degrees have one less.
            (acc["total"] + F.when(k * 2 <= degrees, F.exp(acc["log"])).otherwise(F.lit(0.0))).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    tail = F.when(odd, erfc(F.sqrt(half)) + terms).otherwise(terms)
    return (
        F.when((degrees < 1) | (statistic <= 0), F.lit(1.0))
        .when(statistic == float("inf"), F.lit(0.0))
        .otherwise(F.least(tail, F.lit(1.0)))
    )
