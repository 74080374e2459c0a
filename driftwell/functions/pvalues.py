"""p-values of already aggregated test statistics (one row per tested column).

All but the exact Kolmogorov-Smirnov tail are column expressions, which need no Python
worker.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SERIES_TERMS = 100
SMALL_LAMBDA = 0.2
# Above this n * m / (n + m) * D^2 the tail is below any double; mass that is left out.
SURE_EXIT = 380.0
NO_MASS = 1e-310


def kolmogorov_series(lam: Column, terms: int = SERIES_TERMS) -> Column:
    """Upper tail of Kolmogorov's limit law at ``lam``, clamped to [0, 1].

    Below .2 the tail is 1 to machine precision while the cut series is not.
    """
    tail = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, j: acc
        + F.when(j % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0))
        * F.exp(F.lit(-2.0) * j * j * lam * lam),
    )
    return F.when(lam < SMALL_LAMBDA, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail))
    )


def _bound(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def path_exit(m: int, n: int, distance: float) -> float | None:
    """Mass of the uniform lattice paths from (0, 0) to (m, n) that somewhere touch
    |x/m - y/n| >= distance.

    Adding up the exits, not 1 - survivors, keeps tiny values accurate. A step holds the
    places inside the band only, without tails below what a double can tell from 0, so
    memory grows with the root of the samples' sizes and work with their power 1.5.
    """
    short, long = sorted((int(m), int(n)))
    limit = math.floor(distance * short * long + 0.5)
    if limit <= 0:
        return 1.0
    if short <= 0:
        return None
    total = short + long
    # The tail is at most e * exp(-2 * squared).
    if distance * distance * short * long / total > SURE_EXIT:
        return 0.0
    mass, at, out = np.ones(1), 0, 0.0  # ``at``: steps to the right of the first place
    for t in range(total):
        right = mass * ((short - at - np.arange(len(mass))) / (total - t))
        moved = np.zeros(len(mass) + 1)
        moved[:-1] = mass - right
        moved[1:] += right
        # Places inside the band: x * total strictly within limit of (t + 1) * short.
        middle = (t + 1) * short
        first = max((middle - limit) // total + 1, at)
        end = min(-(-(middle + limit) // total), at + len(moved))
        if first > at:
            out += float(moved[: first - at].sum())
        if end < at + len(moved):
            out += float(moved[max(end, first) - at :].sum())
        mass, at = moved[first - at : max(end, first) - at], first
        if not len(mass):
            break
        if mass[0] < NO_MASS or mass[-1] < NO_MASS:
            held = np.nonzero(mass >= NO_MASS)[0]
            if not len(held):
                break
            mass, at = mass[held[0] : held[-1] + 1], at + int(held[0])
    return min(1.0, max(0.0, out))


def ks_exact_p(m: Column, n: Column, distance: Column) -> Column:
    """P(two-sample D >= distance) when both samples share one continuous law, from the
    sample sizes and D; null if any is. See `path_exit`; rows are independent."""

    @F.pandas_udf("double")
    def exits(m: pd.Series, n: pd.Series, d: pd.Series) -> pd.Series:
        rows = [None if r.isna().any() else path_exit(*r) for _, r in pd.concat([m, n, d], axis=1).iterrows()]
        return pd.Series(rows, dtype="float64")

    return exits(m.cast("double"), n.cast("double"), distance.cast("double"))


def log_gamma(a: Column) -> Column:
    """ln of the gamma function for a > 0: Stirling's series ten steps on, and back."""
    def far(z: Column) -> Column:
        inverse = 1.0 / z
        square = inverse * inverse
        tail = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square * (1 / 1680 - square / 1188))))
        return (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + tail

    back = F.aggregate(F.sequence(F.lit(0), F.lit(9)), F.lit(0.0), lambda acc, i: acc + F.ln(a + i))
    return far(a + 10) - back


def upper_gamma(a: Column, x: Column) -> Column:
    """Regularized upper incomplete gamma function for a > 0: a series below a + 1, a
    continued fraction above, evaluated from its far end. 1 for x <= 0, null for null."""
    rounds = F.sequence(F.lit(1), (F.lit(150) + 12 * F.sqrt(a)).cast("int"))
    safe = F.greatest(x, F.lit(1e-300))
    front = F.exp(a * F.ln(safe) - safe - log_gamma(a))
    series = F.aggregate(
        rounds,
        F.struct((1.0 / a).alias("sum"), (1.0 / a).alias("term")),
        lambda s, n: _bound(
            s["term"] * safe / (a + n), lambda term: F.struct((s["sum"] + term).alias("sum"), term.alias("term"))
        ),
        lambda s: F.lit(1.0) - front * s["sum"],
    )
    fraction = F.aggregate(
        F.reverse(rounds),
        safe + 2 * F.size(rounds) + 1 - a,
        # Where the series holds, the fraction may meet a zero; it isn't used there.
        lambda f, n: safe + 2 * n - 1 - a - F.coalesce(F.try_divide(n * (n - a), f), F.lit(0.0)),
        lambda f: F.try_divide(front, f),
    )
    p = F.when(x <= 0, F.lit(1.0)).when(x < a + 1, series).otherwise(fraction)
    return F.when(x.isNotNull() & a.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))


def normal_two_sided_p(z: Column) -> Column:
    """2 * P(Z > |z|)."""
    return upper_gamma(F.lit(0.5), z * z / 2)


def chi_square_p(x: Column, dof: Column) -> Column:
    """Upper tail of chi-square; 1 without degrees of freedom."""
    free = F.greatest(dof, F.lit(1)).cast("double")
    return F.when(dof <= 0, F.lit(1.0)).otherwise(upper_gamma(free / 2, x.cast("double") / 2))
