from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from driftwell.spec import CREDIT  # noqa: E402
from driftwell.testing import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", "4")


# Half-open ranges of the synthetic credit table.
RANGES = {
    "status": (1, 5),
    "duration": (6, 60),
    "credit_history": (1, 5),
    "purpose": (1, 5),
    "amount": (500, 10000),
    "savings": (1, 5),
    "employment_duration": (1, 5),
    "installment_rate": (1, 5),
    "personal_status_sex": (1, 5),
    "other_debtors": (1, 3),
    "present_residence": (1, 5),
    "property": (1, 4),
    "age": (18, 70),
    "other_installment_plans": (1, 4),
    "housing": (1, 4),
    "number_credits": (1, 4),
    "job": (1, 4),
    "people_liable": (1, 3),
    "telephone": (1, 3),
    "foreign_worker": (1, 3),
    "credit_risk": (0, 2),
}


def credit_rows(n: int, seed: int = 42) -> list[tuple]:
    rng = random.Random(seed)
    return [tuple(rng.randrange(lo, hi) for lo, hi in RANGES.values()) for _ in range(n)]


@pytest.fixture(scope="session")
def credit(spark):
    """100 applications with a row key."""
    rows = [(i, *r) for i, r in enumerate(credit_rows(100))]
    names = ", ".join(f"{c} long" for c in ["row_key", *RANGES])
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def credit_spec():
    return CREDIT
