import json

import pytest

from gatewatch.__main__ import main


def test_ingest_backfill_quality(spark, tmp_path, capsys):
    log = tmp_path / "auth.csv"
    log.write_text("time,user,computer\n" + "".join(f"{n},U{n % 3},C{n % 5}\n" for n in range(1, 60)))
    base = ["--base", str(tmp_path / "lake")]
    days = ["--start-date", "1970-01-01", "--end-date", "1970-01-02"]
    assert main([*base, "ingest", str(log), "--max-events", "50"]) == 0
    assert main([*base, "--risk", '{"burst_login_event_count_1h": 2}', "backfill", *days]) == 0
    assert main([*base, "daily", *days]) == 0
    capsys.readouterr()
    assert main([*base, "quality"]) == 0
    text = capsys.readouterr().out.strip()
    report, line = json.loads(text[: text.rindex("\n")]), json.loads(text.splitlines()[-1])
    assert report["total_rows"] == line["total"] == 50 and report["overall_status"] == "PASS"

    suite = tmp_path / "suite.json"
    check = {"name": "never", "type": "not_null", "column": "src_host"}
    suite.write_text(json.dumps({"table": "t", "checks": [check]}))
    assert main([*base, "quality", "--suite", str(suite), "--markdown"]) == 2
    assert main([*base, "refresh"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == ["1970-01-01"]
    assert main([*base, "fold-history"]) == 0
    # Stored long after their time, and all events of the day are there: only freshness is violated.
    assert main([*base, "sla", *days]) == 2
    assert [v["check_name"] for v in json.loads(capsys.readouterr().out)] == ["freshness_p95"]
    with pytest.raises(SystemExit):
        main([*base, "daily", "--start-date", "1970-01-02", "--end-date", "1970-01-01"])


def test_quality_looks_at_the_files(spark, tmp_path, capsys):
    """A table whose files lack declared columns fails, though a scan would show them as NULL."""
    spark.sql("SELECT timestamp'2024-03-01 00:00:00' AS event_time, 'U1' AS user_id, '2024-03-01' AS event_date").write.partitionBy(
        "event_date"
    ).parquet(str(tmp_path / "lake/curated/auth_events_curated"))
    assert main(["--base", str(tmp_path / "lake"), "quality"]) == 2
    text = capsys.readouterr().out.strip()
    report = json.loads(text[: text.rindex("\n")])
    failed = [c for c in report["checks"] if c["status"] == "FAIL"]
    assert [c["name"] for c in failed] == ["schema_columns"]
    assert "risk_score" in json.dumps(failed[0]["details"]) and "event_date" not in json.dumps(failed[0]["details"])
