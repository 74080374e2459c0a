"""Declared columns of a table: kind, domain, default. Used by cleaning, checks and drift."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One column.

    kind: ``numeric`` (continuous), ``category`` (bounded integer code),
    ``integer`` (whole number that cleaning leaves in place) or ``label``.
    lo/hi: cleaning domain, None where cleaning does not clip.
    check_lo/check_hi: range a new record must keep; lo/hi where not set.
    default: value taken when a form leaves the field out.
    source: column name in the raw table.
    """

    name: str
    kind: str
    lo: int | None = None
    hi: int | None = None
    check_lo: int | None = None
    check_hi: int | None = None
    default: float | None = None
    source: str | None = None

    @property
    def check_range(self) -> tuple[int | None, int | None]:
        low = self.lo if self.check_lo is None else self.check_lo
        high = self.hi if self.check_hi is None else self.check_hi
        return low, high


@dataclass(frozen=True)
class TableSpec:
    fields: tuple[Field, ...]
    junk: tuple[str, ...] = ()

    def names(self, *kinds: str) -> list[str]:
        return [f.name for f in self.fields if not kinds or f.kind in kinds]

    @property
    def label(self) -> str | None:
        return next((f.name for f in self.fields if f.kind == "label"), None)

    @property
    def features(self) -> list[str]:
        return [f.name for f in self.fields if f.kind != "label"]

    @property
    def renames(self) -> dict[str, str]:
        return {f.source: f.name for f in self.fields if f.source}

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)

    def with_domain(self, **domains: tuple[int, int]) -> "TableSpec":
        """The same table with other cleaning domains for some columns."""
        return replace(
            self,
            fields=tuple(
                replace(f, lo=domains[f.name][0], hi=domains[f.name][1])
                if f.name in domains
                else f
                for f in self.fields
            ),
        )

    def raw_schema(self) -> T.StructType:
        """Every raw column as text, so that dirt reaches the cleaner intact."""
        names = [f.source or f.name for f in self.fields] + list(self.junk)
        return T.StructType([T.StructField(n, T.StringType()) for n in names])

    def clean_schema(self) -> T.StructType:
        types = {
            "numeric": T.LongType(),
            "integer": T.LongType(),
            "label": T.LongType(),
            "category": T.IntegerType(),
        }
        return T.StructType([T.StructField(f.name, types[f.kind]) for f in self.fields])


# Columns of the credit application table with their raw names,
# code domains, request ranges and form defaults.
CREDIT = TableSpec(
    fields=(
        Field("status", "category", 1, 4, source="laufkont"),
        Field("duration", "numeric", check_lo=1, check_hi=72, source="laufzeit"),
        Field("credit_history", "category", 0, 4, source="moral"),
        Field("purpose", "category", 0, 10, source="verw"),
        Field("amount", "numeric", check_lo=250, check_hi=20000, source="hoehe"),
        Field("savings", "category", 1, 5, source="sparkont"),
        Field("employment_duration", "category", 1, 5, default=3.0, source="beszeit"),
        Field("installment_rate", "category", 1, 4, default=4.0, source="rate"),
        Field("personal_status_sex", "category", 1, 4, default=3.0, source="famges"),
        Field("other_debtors", "category", 1, 3, default=1.0, source="buerge"),
        Field("present_residence", "category", 1, 4, default=4.0, source="wohnzeit"),
        Field("property", "category", 1, 4, default=3.0, source="verm"),
        Field("age", "numeric", check_lo=18, check_hi=100, source="alter"),
        Field("other_installment_plans", "category", 1, 3, default=3.0, source="weitkred"),
        Field("housing", "category", 1, 3, default=2.0, source="wohn"),
        Field("number_credits", "integer", check_lo=1, check_hi=4, default=1.0, source="bishkred"),
        Field("job", "category", 1, 4, default=3.0, source="beruf"),
        Field("people_liable", "integer", check_lo=1, check_hi=2, default=1.0, source="pers"),
        Field("telephone", "category", 1, 2, default=1.0, source="telef"),
        Field("foreign_worker", "category", 1, 2, default=2.0, source="gastarb"),
        Field("credit_risk", "label", source="kredit"),
    ),
    junk=("mixed_type_col",),
)
