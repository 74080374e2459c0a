"""Column helpers: each takes and returns Spark columns and stays inside codegen."""

from driftwell.functions.columns import (
    bin_right_closed,
    clip,
    is_number,
    keep_listed,
    keyed_uniform,
    no_nan,
    recode,
    risk_band,
    to_number,
    verdict,
)
from driftwell.functions.pvalues import (
    chi_square_p,
    kolmogorov_series,
    ks_exact_p,
    normal_two_sided_p,
)

__all__ = [
    "bin_right_closed",
    "chi_square_p",
    "clip",
    "is_number",
    "keep_listed",
    "keyed_uniform",
    "kolmogorov_series",
    "ks_exact_p",
    "no_nan",
    "normal_two_sided_p",
    "recode",
    "risk_band",
    "to_number",
    "verdict",
]
