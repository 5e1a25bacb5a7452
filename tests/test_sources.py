import bz2
import json

import pytest
from pyspark.sql import functions as F

from gatewatch.sources import logs, payload, validate
from helpers import event, frame

SAMPLE = ["time,user,computer", "1,U1,C1", "2,U1,C2", "3,U2,C1", "4,U3,C9", "5,U2,C2", "6,U1,C1", "7,U3,C9", "8,U4,C3"]
SPOILED = ["", "  ", "x,U1,C1", "1,U1", "1,U1,C1,", "9,,C1", "9,U1, ", "99999999999999999999,U1,C1", ' 10 , U"1 ,\tC1 ']


def write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_sample_log(spark, tmp_path):
    rows = logs.read_log(spark, write(tmp_path / "a.csv", SAMPLE)).orderBy("event_time").collect()
    assert [(r.user_id, r.computer_id) for r in rows] == [tuple(s.split(",")[1:]) for s in SAMPLE[1:]]
    assert rows[0].event_id == "9341c1af8b819d9bfb1ffee11659a83f"
    assert rows[0].event_time.isoformat() == "1970-01-01T00:00:01"
    assert all(len(r.event_id) == 32 for r in rows)


def test_bad_lines_keep_their_reason(spark):
    parsed = logs.parse_lines(lines(spark, SPOILED))
    reasons = {r.raw_line: r.reject_reason for r in parsed.collect()}
    assert reasons == {
        "x,U1,C1": "time_not_digits",
        "1,U1": "field_count",
        "1,U1,C1,": "field_count",
        "9,,C1": "blank_user_id",
        "9,U1, ": "blank_computer_id",
        "99999999999999999999,U1,C1": "time_out_of_range",
        ' 10 , U"1 ,\tC1 ': None,
    }
    good = parsed.filter("reject_reason IS NULL").first()
    assert (good.user_id, good.computer_id) == ('U"1', "C1")
    counts = {r.outcome: r.records for r in validate.reject_counts(parsed).collect()}
    assert counts["ok"] == 1 and counts["field_count"] == 2


def test_compressed_log(spark, tmp_path):
    path = tmp_path / "auth.txt.bz2"
    path.write_bytes(bz2.compress("\n".join(SAMPLE).encode()))
    assert logs.read_log(spark, str(path)).count() == 8


def test_line_numbers_over_split_files(spark, tmp_path):
    for name in ("a", "b"):
        write(tmp_path / f"{name}.txt", [f"{n},{name},C{n}" for n in range(500)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        numbered = logs.number_lines(logs.read_lines(spark, str(tmp_path)))
        assert numbered.rdd.getNumPartitions() > 3
        rows = numbered.select("value", logs.LINE_NUMBER).collect()
        assert len(rows) == 1000
        assert all(r.value.split(",")[0] == str(r.line_number) for r in rows)
        assert logs.read_log(spark, str(tmp_path), start_line=498).count() == 4
        ids = {r.event_id for r in logs.read_log(spark, str(tmp_path), event_id="joined_line").collect()}
        assert "0-a-C0-1" in ids and "499-b-C499-500" in ids
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bounded_read_and_options(spark, tmp_path):
    path = write(tmp_path / "a.txt", SAMPLE)
    assert logs.read_log(spark, path, max_events=3).count() == 3
    shifted = logs.read_log(spark, path, base_epoch=1_704_067_200, event_id="joined").orderBy("event_time").first()
    assert shifted.event_time.isoformat() == "2024-01-01T00:00:01" and shifted.event_id == "1-U1-C1"
    with pytest.raises(ValueError):
        logs.read_log(spark, path, event_id="other")


def test_payload_validation(spark):
    good = {"event_time": "1970-01-01T00:00:01Z", "user_id": " U1 ", "computer_id": " C1 ", "event_id": " e1 "}
    cases = {
        json.dumps(good): None,
        json.dumps({**good, "event_time": "2024-01-01T02:00:00+02:00"}): None,
        json.dumps({**good, "event_time": "2024-01-01T00:00:00"}): "event_time_without_zone",
        json.dumps({**good, "event_time": "2024-13-01T00:00:00Z"}): "event_time_without_zone",
        json.dumps({**good, "user_id": " "}): "blank_user_id",
        json.dumps({**good, "computer_id": "\t"}): "blank_computer_id",
        json.dumps({k: v for k, v in good.items() if k != "event_id"}): "blank_event_id",
        json.dumps({k: v for k, v in good.items() if k != "event_time"}): "missing_event_time",
        json.dumps({**good, "extra": 1}): "unknown_field",
        "{not json": "malformed_json",
    }
    rows = payload.decode_payload(lines(spark, list(cases)), strict=True).collect()
    assert {r.raw_payload: r.reject_reason for r in rows} == cases
    first = next(r for r in rows if r.raw_payload == json.dumps(good))
    assert (first.user_id, first.computer_id, first.event_id) == ("U1", "C1", "e1")
    zoned = next(r for r in rows if "+02:00" in r.raw_payload)
    assert zoned.event_time.isoformat() == "2024-01-01T00:00:00"
    lenient = payload.decode_payload(lines(spark, list(cases)))
    assert lenient.filter("reject_reason = 'unknown_field'").count() == 0


def test_keyed_payload(spark):
    sent = payload.encode_payload(frame(spark, [event(1.5), event(2, user="")])).collect()
    assert [r.key for r in sent] == ["U1"]
    assert set(json.loads(sent[0].value)) == {"event_time", "user_id", "computer_id", "event_id"}
    assert json.loads(sent[0].value)["event_time"] == "2024-03-01T00:00:01.500000Z"
    by_host = payload.encode_payload(frame(spark, [event(1)]), key="computer_id").first()
    assert by_host.key == "C1"


def test_summary_and_invalid_rate(spark):
    rows = [event(10), event(20, host=" "), event(4000)]
    checked = validate.validate_events(frame(spark, rows))
    summary = payload.ingest_summary(checked, elapsed_seconds=2).first()
    assert (summary.sent, summary.failed, summary.throughput_events_per_sec) == (2, 1, 1.0)
    rates = validate.invalid_rate(checked, F.date_trunc("hour", "event_time"), "hour").orderBy("hour").collect()
    assert [(r.invalid_records, r.invalid_pct, r.breached) for r in rates] == [(1, 50.0, True), (0, 0.0, False)]
    assert validate.dead_letters(checked).count() == 1


def test_scoring_view_fills_success(spark):
    view = validate.scoring_view(frame(spark, [event(1, success=None), event(2, success=False), event(3, host="")]))
    assert [r.success for r in view.orderBy("event_time").collect()] == [True, False]
    assert "dst_host" in view.columns and "computer_id" not in view.columns


def test_bounded_read_takes_the_first_events_in_order(spark, tmp_path):
    for n in range(4):
        (tmp_path / f"{n}.txt").write_text("time,user,computer\n" + "".join(f"{n * 100 + k},U{n},C{k}\n" for k in range(20)))
    taken = logs.read_log(spark, str(tmp_path), max_events=25)
    assert taken.columns == logs.read_log(spark, str(tmp_path)).columns
    assert sorted(r.event_time.timestamp() for r in taken.collect()) == [*range(20), *range(100, 105)]
    later = logs.read_log(spark, str(tmp_path), start_line=11, max_events=12)
    assert sorted(r.event_time.timestamp() for r in later.collect()) == [*range(10, 20), 110, 111]
