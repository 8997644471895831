"""What a check is, and how a list of checks becomes one metrics DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierkit.sources.layers import materialize_table


class ChecksFailed(Exception):
    """At least one check ended in an error."""


@dataclass(frozen=True)
class Keyed:
    """What a check counts by key: rows that share one, rows whose key the parent lacks, or with
    ``distinct`` the keys themselves.

    Up to two whole numbers are a key as they are. Other keys are compared as text with NULL kept
    apart, by 128 bits of hash. ``skip_null`` leaves NULL keys out.
    """

    columns: Sequence[str]
    skip_null: bool = True
    condition: str | Column | None = None
    distinct: bool = False
    parent: DataFrame | None = None
    parent_columns: Sequence[str] = ()
    parent_condition: str | None = None


@dataclass(frozen=True)
class Check:
    """A named rule over one table.

    ``find`` returns the violations and ``fail_calc`` turns them into a number. Where that
    number is a plain aggregate over the table, ``tally`` gives it directly, or as a function of
    the table; all tallies over one table share a single scan. Checks with ``keyed`` share one
    more. NULL comparisons are not violations unless said.
    """

    name: str
    find: Callable[[DataFrame], DataFrame]
    fail_calc: str = "count(*)"
    tally: Column | Callable[[DataFrame], Column] | None = None
    keyed: Keyed | None = None
    where: str | None = None
    severity: str = "error"
    warn_if: str = "!= 0"
    error_if: str = "!= 0"

    def named(self, name: str) -> Check:
        return replace(self, name=name)

    def only(self, where: str) -> Check:
        """The same rule over the rows that satisfy ``where``."""
        return replace(self, where=where)

    def limits(self, severity: str = "error", warn_if: str = "!= 0", error_if: str = "!= 0") -> Check:
        if severity not in ("warn", "error"):
            raise ValueError(f"severity must be warn or error, got {severity!r}")
        return replace(self, severity=severity, warn_if=warn_if, error_if=error_if)

    def violations(self, df: DataFrame) -> DataFrame:
        return self.find(df if self.where is None else df.filter(self.where))


def row_check(name: str, bad: Column) -> Check:
    """Every row for which ``bad`` is true is a violation."""
    return Check(name, lambda df: df.filter(bad), tally=F.count_if(bad))


def _verdict(check: Check, count: str) -> Column:
    """One metrics row from the column that holds a check's number of failures."""
    error = F.expr(f"{count} {check.error_if}") & F.lit(check.severity == "error")
    warn = F.expr(f"{count} {check.warn_if}")
    return F.struct(
        F.lit(check.name).alias("check"),
        F.col(count).alias("failures"),
        warn.alias("should_warn"),
        error.alias("should_error"),
        F.when(error, "error").when(warn, "warn").otherwise("pass").alias("status"),
    )


def run_checks(plan: Iterable[tuple[DataFrame, Check]]) -> DataFrame:
    """One row per check: check, failures, should_warn, should_error, status.

    A table is scanned once for all its tallies and once for all keys that any check needs of
    it, whatever the number of checks; other checks read their own columns.
    """
    plan = list(plan)
    scans: dict[tuple, tuple[DataFrame, list[Check]]] = {}
    counted: list[tuple[DataFrame, list[Check]]] = []
    keyed = [(df, check) for df, check in plan if check.keyed is not None]
    if keyed:
        counted.append((_count_keys(keyed), [check for _, check in keyed]))
    for df, check in plan:
        if check.keyed is not None:
            continue
        if check.tally is None:
            counted.append((check.violations(df).agg(_as_count(F.expr(check.fail_calc), 0)), [check]))
        else:
            source = df if check.where is None else df.filter(check.where)
            scans.setdefault((id(df), check.where), (source, []))[1].append(check)
    for df, checks in scans.values():
        tallies = [c.tally(df) if callable(c.tally) else c.tally for c in checks]
        counted.append((df.agg(*[_as_count(t, i) for i, t in enumerate(tallies)]), checks))
    rows = [df.select(F.inline(F.array(*[_verdict(c, f"n{i}") for i, c in enumerate(cs)]))) for df, cs in counted]
    return reduce(DataFrame.union, rows)


def _count_keys(plan: list[tuple[DataFrame, Check]]) -> DataFrame:
    """One row with the failures ``n0, n1, ...`` of all keyed checks.

    Each table gives a row for each check and key in one scan, as child or as parent; one
    aggregate, partial before its only shuffle, brings the sides of a key together. A key is two
    64-bit numbers whatever its columns, so keys that hardly repeat move as little as can be.
    """
    sides: dict[int, tuple[DataFrame, list[Column]]] = {}

    def add(df: DataFrame, number: int, columns, condition: Column, child: bool, whole: bool) -> None:
        high, low = _key(columns, whole)
        taken = F.when(condition, F.lit(number)).alias("number")
        cell = F.struct(taken, high.alias("high"), low.alias("low"), F.lit(child).alias("child"))
        sides.setdefault(id(df), (df, []))[1].append(cell)

    def filled(columns, *conditions: str | Column | None) -> Column:
        out = F.lit(True)
        for c in columns:
            out &= F.col(c).isNotNull()
        for c in conditions:
            out = out if c is None else out & (F.expr(c) if isinstance(c, str) else c)
        return out

    for number, (df, check) in enumerate(plan):
        k = check.keyed
        whole = _whole_numbers(df, k.columns) and (k.parent is None or _whole_numbers(k.parent, k.parent_columns))
        add(df, number, k.columns, filled(k.columns if k.skip_null else (), k.condition, check.where), True, whole)
        if k.parent is not None:
            add(k.parent, number, k.parent_columns, filled(k.parent_columns, k.parent_condition), False, whole)
    # an array of plain structs is never built: the generator runs inside the compiled stage
    cells = [df.select(F.inline(F.array(*rows))).filter("number IS NOT NULL") for df, rows in sides.values()]
    children = F.count_if("child")
    per_key = reduce(DataFrame.union, cells).groupBy("number", "high", "low").agg(
        children.alias("n"), F.max(~F.col("child")).alias("known")
    )

    def failures(number: int, check: Check) -> Column:
        mine = F.col("number") == number
        if check.keyed.distinct:
            return F.count_if(mine)
        if check.keyed.parent is None:
            return F.count_if(mine & (F.col("n") > 1))
        return F.sum(F.when(mine & ~F.col("known"), F.col("n")))

    return per_key.agg(*[_as_count(failures(i, c), i) for i, (_, c) in enumerate(plan)])


def _whole_numbers(df: DataFrame, columns: Sequence[str]) -> bool:
    kinds = [df.select(c).schema[0].dataType for c in columns]
    return len(kinds) <= 2 and all(isinstance(k, T.IntegralType) for k in kinds)


def _key(columns: Sequence[str], whole: bool) -> tuple[Column, Column]:
    """A key as two 64-bit numbers; NULL differs from any text, also in several columns."""
    if whole:
        numbers = [F.col(c).cast("long") for c in columns]
        return numbers[0], numbers[1] if len(numbers) == 2 else F.lit(0).cast("long")
    parts = [p for c in columns for p in (F.col(c).cast("string"), F.col(c).isNull())]
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)


def _as_count(value: Column, i: int) -> Column:
    return F.coalesce(value.cast("bigint"), F.lit(0)).alias(f"n{i}")


def gate(metrics: DataFrame) -> list:
    """Raise when a check ended in an error; warnings pass. Fetches one row per check."""
    rows = metrics.collect()
    failed = [f"{r['check']} ({r['failures']})" for r in rows if r["status"] == "error"]
    if failed:
        raise ChecksFailed(", ".join(failed))
    return rows


def store_failures(df: DataFrame, check: Check, table: str) -> DataFrame:
    """Keep the violations of a check as a table, in place of those of the run before."""
    return materialize_table(check.violations(df), table)
