import pytest

from gatewatch.config import RiskConfig
from gatewatch.functions import risk

COLUMNS = (
    "window_1h_event_count long, window_1h_unique_hosts long, window_24h_unique_hosts long, has_new_device boolean"
)


def score(spark, *values, cfg=None):
    row = risk.apply_risk_engine(spark.createDataFrame([values], COLUMNS), cfg).first()
    return row.risk_score, row.risk_flags


def test_all_rules_fire(spark):
    assert score(spark, 100, 12, 30, True) == (100, list(risk.RULES))


@pytest.mark.parametrize(
    "values, expected",
    [
        ((49, 9, 24, False), (0, [])),
        ((50, 9, 24, False), (25, ["burst_login"])),
        ((49, 10, 24, False), (35, ["lateral_movement"])),
        ((49, 9, 24, True), (10, ["rare_host"])),
        ((49, 9, 25, True), (40, ["rare_host", "new_device_spike"])),
        ((49, 9, 25, False), (0, [])),
        ((None, None, None, None), (0, [])),
    ],
)
def test_boundaries(spark, values, expected):
    assert score(spark, *values) == expected


def test_partial_overrides(spark):
    cfg = {"burst_login_event_count_1h": 2, "weight_burst_login": 7}
    assert score(spark, 2, 0, 0, False, cfg=cfg) == (7, ["burst_login"])
    with pytest.raises(ValueError):
        RiskConfig.of({"no_such_rule": 1})


def test_popularity_mode_reads_its_own_column(spark):
    df = spark.createDataFrame([(1, 1, 30, True, False), (1, 1, 1, False, True)], COLUMNS + ", is_rare_host boolean")
    rows = risk.apply_risk_engine(df, RiskConfig(rare_host_mode="popularity")).collect()
    assert [r.risk_flags for r in rows] == [["new_device_spike"], ["rare_host"]]


def test_sql_functions(spark):
    risk.register_risk_functions(spark)
    row = spark.sql(
        "SELECT risk_score('U1', 'C1', NULL, NULL, 100, 12, 30, true) s, "
        "risk_flags('U1', 'C1', NULL, NULL, 100, 12, 30, true) f, "
        "risk_score('U1', NULL, NULL, NULL, NULL, NULL, NULL, NULL) z, "
        "risk_flags('U1', NULL, NULL, NULL, NULL, NULL, NULL, NULL) e"
    ).first()
    assert (row.s, row.f, row.z, row.e) == (100, list(risk.RULES), 0, [])


def test_levels(spark):
    df = spark.createDataFrame([(s,) for s in (0, 25, 26, 50, 51, 75, 76, 100)], "risk_score int")
    rows = df.select(risk.risk_level().alias("l"), risk.triage_level().alias("t")).collect()
    assert [r.l for r in rows] == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL", "CRITICAL"]
    assert [r.t for r in rows] == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL", "CRITICAL", "CRITICAL"]


def test_basic_rules(spark):
    df = spark.createDataFrame([(True, True), (False, None)], "a boolean, b boolean")
    total, flags = risk.evaluate_basic_risk("a", "b")
    assert [tuple(r) for r in df.select(total, flags).collect()] == [(50, ["new_device", "login_burst"]), (0, [])]


def test_sql_functions_refuse_the_popularity_mode(spark):
    with pytest.raises(ValueError):
        risk.register_risk_functions(spark, RiskConfig(rare_host_mode="popularity"))
