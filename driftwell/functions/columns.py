from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a number that a lenient text-to-number reader takes.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITY_PATTERN = r"^[+-]?(?i:inf|infinity)$"

# Lower bounds of the good-probability bands, highest first.
RISK_BANDS = ((0.7, "BAJO"), (0.4, "MEDIO"))
RISK_BAND_ELSE = "ALTO"


def is_number(c: Column) -> Column:
    """True where the trimmed text reads as a number; missing gives NULL."""
    text = F.trim(c.cast("string"))
    return text.rlike(NUMBER_PATTERN) | text.rlike(INFINITY_PATTERN)


def to_number(c: Column) -> Column:
    """Text to double. Junk, empty text and 'nan' become NULL.

    The pattern guards the cast because Spark alone reads '1d' as 1.0.
    """
    text = F.trim(c.cast("string"))
    infinite = F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(
        F.lit(float("inf"))
    )
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double")).when(
        text.rlike(INFINITY_PATTERN), infinite
    )


def no_nan(c: Column) -> Column:
    """Double column with NaN turned into NULL, the only missing marker we use."""
    number = c.cast("double")
    return F.when(~F.isnan(number), number)


def clip(c: Column, lo, hi) -> Column:
    """Clamp to [lo, hi], keeping NULL (`greatest` alone would drop it)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


def keep_listed(c: Column, values: Sequence) -> Column:
    """Values outside the list become NULL."""
    return F.when(c.isin(list(values)), c)


def recode(c: Column, mapping: Mapping) -> Column:
    """Replace listed values; all others, NULL included, pass through."""
    if not mapping:
        return c
    out = None
    for old, new in mapping.items():
        out = (F if out is None else out).when(c == F.lit(old), F.lit(new))
    return out.otherwise(c)


def keyed_uniform(keys: Sequence[str], salt: str) -> Column:
    """Uniform [0, 1) double fixed by the key columns and the salt.

    Depends on row content only, so a recomputed task draws the same numbers.
    52 bits of the digest, which a double holds exactly.
    """
    key_text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(salt))
    head = F.conv(F.substring(F.md5(key_text), 1, 13), 16, 10)
    return head.cast("double") / F.lit(float(2**52))


def bin_right_closed(c: Column, edges: Sequence[float], widen: bool = True) -> Column:
    """Bin number for right-closed bins with the lowest edge included.

    ``widen`` stretches the outer bins over every value; otherwise values
    outside the edges get NULL, as missing ones do.
    """
    inner = edges[1:-1]
    number = reduce(
        lambda total, e: total + (c > F.lit(float(e))).cast("int"), inner, F.lit(0)
    )
    inside = c.isNotNull()
    if not widen:
        inside = inside & c.between(F.lit(float(edges[0])), F.lit(float(edges[-1])))
    return F.when(inside, number)


def risk_band(probability_good: Column) -> Column:
    out = None
    for bound, name in RISK_BANDS:
        out = (F if out is None else out).when(probability_good >= bound, F.lit(name))
    return F.when(probability_good.isNotNull(), out.otherwise(F.lit(RISK_BAND_ELSE)))


def verdict(predicted: Column) -> Column:
    return F.when(predicted == 1, F.lit("approve")).when(predicted == 0, F.lit("reject"))
