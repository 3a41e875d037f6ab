"""Zero-rows data-quality checks.

A check is a DataFrame of *violating* rows: empty means pass.  Every check
that could pass vacuously carries a *floor*: a row emitted when the
population it inspects is empty, so an emptied upstream table turns the
build red instead of green.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Check:
    name: str
    violations: DataFrame
    severity: str = "error"

    def count(self) -> int:
        return self.violations.count()


@dataclass
class CheckResult:
    name: str
    severity: str
    violations: int

    @property
    def passed(self) -> bool:
        return self.violations == 0


def floor_rows(population: DataFrame, label: str, label_col: str = "violation") -> DataFrame:
    """One row ``(label)`` when ``population`` is empty, else nothing.  A
    global count is computed with partial aggregation (one row per map
    task reaches the final task)."""
    return population.agg(F.count(F.lit(1)).alias("__n")).where("__n = 0").select(F.lit(label).alias(label_col))


def with_floor(violations: DataFrame, population: DataFrame, label: str,
               label_col: str = "violation") -> DataFrame:
    return violations.unionByName(floor_rows(population, label, label_col), allowMissingColumns=True)


def run_checks(checks: Iterable[Check]) -> list[CheckResult]:
    return [CheckResult(c.name, c.severity, c.count()) for c in checks]


# ---------------------------------------------------------------- generic tests
def not_null(df: DataFrame, columns: Sequence[str], where: str | None = None) -> DataFrame:
    """Rows with a NULL in any of ``columns``, tagged with the column."""
    data = df.where(where) if where else df
    flags = F.array(*[F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in columns])
    return data.select("*", F.explode(F.array_compact(flags)).alias("violation"))


def unique(df: DataFrame, keys: Sequence[str], where: str | None = None) -> DataFrame:
    """Key combinations that occur more than once (catches fan-out; pair it
    with a grain sentry to catch loss)."""
    data = df.where(where) if where else df
    return data.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    return child.where(F.col(fk).isNotNull()).join(
        parent.select(F.col(pk).alias("__pk")), F.col(fk) == F.col("__pk"), "left_anti")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(~F.col(column).isin(*values) | F.col(column).isNull())


def expect_string_type(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Plan-time type check (no scan): names of columns that are not strings."""
    return [c for c in columns if df.schema[c].dataType.typeName() != "string"]
