import json

import pytest

from gatewatch.plans import quality

SUITE = {
    "table": "t",
    "failure_threshold_pct": 10,
    "checks": [
        {"name": "shape", "type": "schema", "expected_columns": [{"n": "int"}, {"word": "string"}]},
        {"name": "no_nulls", "type": "not_null", "column": "n"},
        {"name": "bounds", "type": "range", "column": "n", "min": 0, "max": 5},
        {"name": "words", "type": "range", "column": "word", "allowed_values": ["it's", "b"]},
    ],
}


def results(df, suite=SUITE, **options):
    return {r.name: (r.failed_rows, r.failure_pct, r.status) for r in quality.run_suite(df, suite, **options).collect()}


def test_checks(spark):
    data = [(1, "it's"), (None, "b"), (9, None), (-1, "c")] + [(2, "b")] * 16
    df = spark.createDataFrame(data, "n int, word string")
    assert results(df) == {
        "shape": (0, 0.0, "PASS"),
        "no_nulls": (1, 5.0, "PASS"),
        "bounds": (2, 10.0, "PASS"),
        "words": (1, 5.0, "PASS"),
    }
    stats = quality.invalid_record_stats(quality.run_suite(df, SUITE)).first()
    assert (stats.invalid_record_percent, stats.invalid_rows, stats.total_rows) == (10.0, 2, 20)


def test_threshold_is_compared_before_rounding(spark):
    df = spark.range(3).selectExpr("IF(id = 0, NULL, 1) AS n", "'b' AS word")
    strict = {**SUITE, "failure_threshold_pct": 33.333333}
    assert results(df, strict)["no_nulls"] == (1, 33.333333, "FAIL")


def test_schema_differences(spark):
    df = spark.range(5000).selectExpr("id AS n", "'b' AS extra")
    suite = {**SUITE, "checks": SUITE["checks"][:1]}
    assert results(df, suite)["shape"] == (1, 0.02, "FAIL")
    assert results(df, suite, compat=True)["shape"] == (1, 0.02, "PASS")
    found = quality.compare_schema(df, suite["checks"][0]["expected_columns"])
    assert found == {
        "missing": ["word"],
        "mismatched": [{"column": "n", "expected": "int", "actual": "bigint"}],
    }


def test_empty_table(spark):
    df = spark.createDataFrame([], "n int, word string")
    assert all(r == (0, 0.0, "PASS") for r in results(df).values())
    narrow = spark.createDataFrame([], "n int")
    assert results(narrow, {**SUITE, "checks": SUITE["checks"][:1]})["shape"] == (1, 100.0, "FAIL")


def test_one_pass(spark):
    df = spark.createDataFrame([(1, "b")], "n int, word string")
    plan = quality.run_suite(df, SUITE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


@pytest.mark.parametrize(
    "check",
    [
        {"name": "x", "type": "unheard_of"},
        {"name": "x", "type": "not_null"},
        {"name": "x", "type": "range", "column": "n"},
        {"name": "x", "type": "range", "column": "n", "allowed_values": []},
        {"name": "x", "type": "schema", "expected_columns": [{"a": "int", "b": "int"}]},
    ],
)
def test_broken_suites(spark, check):
    df = spark.createDataFrame([(1, "b")], "n int, word string")
    with pytest.raises(ValueError):
        quality.run_suite(df, {"table": "t", "checks": [check]})
    with pytest.raises(ValueError):
        quality.run_suite(df, {"table": "t", "checks": []})


def test_report(spark, tmp_path):
    path = tmp_path / "suite.json"
    path.write_text(json.dumps(SUITE))
    suite = quality.load_suite(str(path))
    df = spark.createDataFrame([(None, "b"), (1, "b")], "n int, word string")
    found = quality.run_suite(df, suite)
    payload = quality.report(found, suite, "2024-03-01T00:00:00Z")
    assert payload["overall_status"] == "FAIL" and payload["total_rows"] == 2
    assert quality.overall_status(found).first().overall_status == "FAIL"
    assert "| no_nulls | FAIL | 1 | 50.0 |" in quality.report_markdown(payload)
    line = json.loads(quality.metric_line(payload))
    assert (line["value"], line["count"], line["total"]) == (50.0, 1, 2)


def test_yaml_suite(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "suite.yml"
    path.write_text("table: t\nchecks:\n  - name: a\n    type: not_null\n    column: n\n")
    assert quality.load_suite(str(path))["checks"][0]["column"] == "n"
