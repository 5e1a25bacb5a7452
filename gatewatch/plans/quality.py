"""Data-quality suites: any number of checks in one pass over the table."""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The checks of the curated table.
CURATED_SUITE = {
    "table": "auth_events_curated",
    "failure_threshold_pct": 0.1,
    "checks": [
        {
            "name": "schema_columns",
            "type": "schema",
            "expected_columns": [
                {"event_time": "timestamp"},
                {"user_id": "string"},
                {"src_host": "string"},
                {"dst_host": "string"},
                {"success": "boolean"},
                {"window_1h_event_count": "bigint"},
                {"window_1h_unique_hosts": "bigint"},
                {"window_24h_unique_hosts": "bigint"},
                {"has_new_device": "boolean"},
                {"risk_score": "int"},
                {"risk_flags": "array<string>"},
            ],
        },
        {"name": "not_null_user_id", "type": "not_null", "column": "user_id"},
        {"name": "not_null_event_time", "type": "not_null", "column": "event_time"},
        {"name": "value_range_risk_score", "type": "range", "column": "risk_score", "min": 0, "max": 100},
        {"name": "allowed_values_success", "type": "range", "column": "success", "allowed_values": [True, False]},
    ],
}


def load_suite(path: str) -> dict:
    """A suite from a YAML or JSON file."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("reading YAML suites needs PyYAML; JSON suites do not") from missing
    return yaml.safe_load(text)


def compare_schema(df: DataFrame | StructType, expected: list[Mapping[str, str]]) -> dict:
    """Expected columns that are missing or of another type. Extra columns are allowed."""
    fields = df.fields if isinstance(df, StructType) else df.schema.fields
    actual = {f.name: f.dataType.simpleString() for f in fields}
    missing, mismatched = [], []
    if any(len(entry) != 1 for entry in expected):
        raise ValueError("each expected column is given as one name with its type")
    for name, kind in (pair for entry in expected for pair in entry.items()):
        wanted = str(kind).lower()
        if name not in actual:
            missing.append(name)
        elif actual[name] != wanted:
            mismatched.append({"column": name, "expected": wanted, "actual": actual[name]})
    return {"missing": missing, "mismatched": mismatched}


def _require_column(check: Mapping) -> str:
    column = str(check.get("column", "")).strip()
    if not column:
        raise ValueError(f"check {check.get('name')!r} names no column")
    return column


def failing(check: Mapping) -> Column:
    """Condition under which a row fails the check. A NULL fails only ``not_null``."""
    value = F.col(_require_column(check))
    if check["type"] == "not_null":
        return value.isNull()
    if "allowed_values" in check:
        if not check["allowed_values"]:
            raise ValueError(f"allowed_values of {check.get('name')!r} is empty")
        return ~value.isin(*check["allowed_values"])
    bounds = []
    if check.get("min") is not None:
        bounds.append(value < F.lit(check["min"]))
    if check.get("max") is not None:
        bounds.append(value > F.lit(check["max"]))
    if not bounds:
        raise ValueError(f"range check {check.get('name')!r} has neither min nor max")
    return bounds[0] if len(bounds) == 1 else bounds[0] | bounds[1]


def run_suite(
    df: DataFrame, suite: Mapping = CURATED_SUITE, compat: bool = False, stored: StructType | None = None
) -> DataFrame:
    """One row per check, from a single aggregation over ``df``.

    Schema checks look at ``stored`` where it is given: a scan with a declared schema shows
    every declared column, whatever its files hold. A schema difference counts as one failed row and always fails the check; with
    ``compat`` it is compared with the threshold like any other share.
    """
    checks = suite.get("checks") or []
    if not str(suite.get("table", "")).strip() or not checks:
        raise ValueError("a suite needs a table and checks")
    threshold = float(suite.get("failure_threshold_pct", 0.1))

    measures, rows = [], []
    total = F.col("total_rows")
    for number, check in enumerate(checks):
        kind = check.get("type")
        details = {k: v for k, v in check.items() if k not in ("name", "type", "expected_columns")}
        if kind == "schema":
            details = compare_schema(df.schema if stored is None else stored, check.get("expected_columns", []))
            failed = F.lit(int(bool(details["missing"] or details["mismatched"]))).cast("long")
        elif kind in ("not_null", "range"):
            measures.append(F.count_if(failing(check)).alias(f"failed_{number}"))
            failed = F.col(f"failed_{number}")
        else:
            raise ValueError(f"unknown check type {kind!r}")
        pct = F.when(total > 0, failed / total * 100.0).otherwise(F.when(failed == 0, 0.0).otherwise(100.0))
        broken = failed > 0 if kind == "schema" and not compat else pct > threshold
        rows.append(
            F.struct(
                F.lit(str(check.get("name") or f"check {len(rows) + 1}")).alias("name"),
                F.lit(kind).alias("type"),
                total.alias("total_rows"),
                failed.alias("failed_rows"),
                F.round(pct, 6).alias("failure_pct"),
                F.when(broken, "FAIL").otherwise("PASS").alias("status"),
                F.lit(json.dumps(details)).alias("details"),
            )
        )
    return df.agg(F.count(F.lit(1)).alias("total_rows"), *measures).select(F.inline(F.array(*rows)))


def invalid_record_stats(results: DataFrame) -> DataFrame:
    """Worst failure share and count over the row-level checks."""
    rows = F.col("type") != "schema"
    return results.agg(
        F.coalesce(F.max(F.when(rows, F.col("failure_pct"))), F.lit(0.0)).alias("invalid_record_percent"),
        F.coalesce(F.max(F.when(rows, F.col("failed_rows"))), F.lit(0)).alias("invalid_rows"),
        F.max("total_rows").alias("total_rows"),
    )


def overall_status(results: DataFrame) -> DataFrame:
    passed = F.bool_and(F.col("status") == "PASS")
    return results.agg(F.when(passed, "PASS").otherwise("FAIL").alias("overall_status"))


def report(results: DataFrame, suite: Mapping, run_at: str) -> dict:
    """The report as a dictionary; reads one row per check."""
    checks = []
    for row in results.collect():
        fields = row.asDict()
        checks.append({**fields, "details": json.loads(fields["details"])})
    return {
        "table": suite["table"],
        "run_ts_utc": run_at,
        "total_rows": checks[0]["total_rows"],
        "failure_threshold_pct": float(suite.get("failure_threshold_pct", 0.1)),
        "checks": checks,
        "overall_status": "PASS" if all(c["status"] == "PASS" for c in checks) else "FAIL",
    }


def report_markdown(payload: Mapping) -> str:
    head = [
        f"# Data quality: {payload['table']}",
        "",
        f"- Run at: {payload['run_ts_utc']}",
        f"- Rows: {payload['total_rows']}",
        f"- Threshold in percent: {payload['failure_threshold_pct']}",
        f"- Status: {payload['overall_status']}",
        "",
        "| Check | Status | Failed rows | Percent |",
        "|---|---|---|---|",
    ]
    body = [f"| {c['name']} | {c['status']} | {c['failed_rows']} | {c['failure_pct']} |" for c in payload["checks"]]
    return "\n".join(head + body) + "\n"


def metric_line(payload: Mapping) -> str:
    """One JSON line with the worst row-level failure share."""
    rows = [c for c in payload["checks"] if c["type"] != "schema"]
    return json.dumps(
        {
            "metric": "dq_invalid_record_percent",
            "value": max((c["failure_pct"] for c in rows), default=0.0),
            "count": max((c["failed_rows"] for c in rows), default=0),
            "total": payload["total_rows"],
            "table": payload["table"],
            "run_ts_utc": payload["run_ts_utc"],
        }
    )
