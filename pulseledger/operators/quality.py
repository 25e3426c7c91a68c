"""Data-quality checks: null, uniqueness and row expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions import aggregate, name, text_literal, union_all
from ..session import materialize


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Violating rows."""
    return df.filter(f"{name(column)} IS NULL")


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; nulls are exempt."""
    counts = aggregate(df.filter(f"{name(column)} IS NOT NULL"), [column], "count(*) AS n_rows")
    return counts.filter("n_rows > 1")


def check_expr(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which the SQL expression is false; unknown passes."""
    return df.filter(f"NOT ({expression})")


@dataclass(frozen=True)
class Suite:
    """Checks on one relation."""

    relation: str
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    expressions: Sequence[str] = ()


SUITES = (
    Suite("stg_segment_tracks", ("event_id", "event_name", "event_at"), ("event_id",)),
    Suite("stg_identity_resolution", ("anonymous_id", "master_user_id"), ("anonymous_id",)),
    Suite(
        "fct_sessions",
        ("session_id", "user_id", "account_id", "session_start_at", "session_end_at"),
        ("session_id",),
        ("session_duration_seconds >= 0", "session_end_at >= session_start_at", "events_in_session >= 1"),
    ),
    Suite("dim_accounts", ("account_id",), ("account_id",)),
    Suite("dim_users", ("user_id",), ("user_id",)),
    Suite("fct_product_metrics_daily", (), ("metric_date",)),
    Suite("fct_account_metrics_daily", ("metric_date", "account_id")),
    Suite("fct_user_metrics_daily", ("metric_date", "user_id")),
)


@dataclass(frozen=True)
class _Check:
    """A check with its number; ``failed`` is SQL that holds for violating rows."""

    number: int
    suite: Suite
    kind: str
    subject: str
    failed: str | None = None


def _numbered(suites: Sequence[Suite]) -> list[_Check]:
    listed = []
    for s in suites:
        listed += [(s, "not_null", c, f"{name(c)} IS NULL") for c in s.not_null]
        listed += [(s, "expression", e, f"NOT ({e})") for e in s.expressions]
        listed += [(s, "unique", c, None) for c in s.unique]
    return [_Check(i, *entry) for i, entry in enumerate(listed)]


def _hashes(column: str) -> tuple[str, str]:
    return f"xxhash64({name(column)})", f"xxhash64({name(column)}, 1)"


def _findings(df: DataFrame, checks: Sequence[_Check]) -> DataFrame:
    """(number, key, more) in one pass: a row per violation of a row check, and
    for each uniqueness check the value's hashes."""
    found = []
    for c in checks:
        key, more = _hashes(c.subject) if c.kind == "unique" else ("0L", "0L")
        condition = c.failed or f"{name(c.subject)} IS NOT NULL"
        found.append(f"IF({condition}, named_struct('number', {c.number}, 'key', {key}, 'more', {more}), NULL)")
    return df.selectExpr(f"inline(filter(array({', '.join(found)}), found -> found IS NOT NULL))")


def _repeated_values(df: DataFrame, column: str, hashes: DataFrame) -> DataFrame:
    """Number of values that occur more than once, among rows of the given hashes."""
    candidates = df.selectExpr(f"{name(column)} AS value", *[f"{h} AS {n}" for n, h in zip(("key", "more"), _hashes(column))])
    candidates = candidates.join(hashes, ["key", "more"], "left_semi")
    return aggregate(check_unique(candidates, "value"), [], "count(*) AS n_violations")


def run_checks(relations: dict[str, DataFrame], suites: Sequence[Suite] = SUITES) -> DataFrame:
    """Report (relation, check_name, subject, n_violations) of every suite whose
    relation is given, one row per check.

    Each relation is read once: violations and the hashes of all values that
    should be unique meet in one grouping. Only rows whose hashes occur more
    than once, normally none, are read again and compared by value.
    """
    suites = [s for s in suites if s.relation in relations]
    if not suites:
        raise ValueError("no suite matches the given relations")
    checks = _numbered(suites)
    own = {s.relation: [c for c in checks if c.suite is s] for s in suites}
    parts = union_all([_findings(relations[r], listed) for r, listed in own.items() if listed])
    groups = aggregate(parts, ["number", "key", "more"], "count(*) AS n_rows")
    by_row = ", ".join(str(c.number) for c in checks if c.kind != "unique") or "-1"
    found = materialize(groups.filter(f"n_rows > 1 OR number IN ({by_row})"), "findings")
    # One row per check.
    rows_found = aggregate(found, ["number"], "sum(n_rows) AS n_rows").collect()
    failing = {r.number: r.n_rows for r in rows_found}
    exact, counted = [], []
    for c in checks:
        label = f"{text_literal(c.suite.relation)} AS relation", f"'{c.kind}' AS check_name", f"{text_literal(c.subject)} AS subject"
        if c.kind == "unique" and c.number in failing:
            repeated = _repeated_values(relations[c.suite.relation], c.subject, found.filter(f"number = {c.number}"))
            exact.append(repeated.selectExpr(*label, "n_violations"))
        else:
            counted.append((c.suite.relation, c.kind, c.subject, failing.get(c.number, 0)))
    report = found.sparkSession.createDataFrame(counted, "relation string, check_name string, subject string, n_violations long")
    return union_all([report, *exact])


def run_suite(df: DataFrame, suite: Suite) -> DataFrame:
    """The checks of one suite."""
    return run_checks({suite.relation: df}, [suite])
