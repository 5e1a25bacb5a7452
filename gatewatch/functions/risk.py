"""Risk rules as Column expressions; they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.config import RiskConfig

# Rule names in the order flags are listed in.
RULES = ("lateral_movement", "burst_login", "rare_host", "new_device_spike")

# Upper ends of the risk levels; above the last one it is CRITICAL.
LEVELS = (("LOW", 25), ("MEDIUM", 50), ("HIGH", 75))
HIGH_LEVELS = ("HIGH", "CRITICAL")

# Weights of the four 0/1 indicators of the wide table.
INDICATOR_WEIGHTS = {
    "is_new_device": 30,
    "is_burst_login": 25,
    "is_lateral_movement": 35,
    "is_rare_host": 10,
}

# Weights of the two-rule score.
BASIC_WEIGHTS = {"new_device": 30, "login_burst": 20}


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _count(value) -> Column:
    return F.coalesce(_col(value), F.lit(0))


def _flag(value) -> Column:
    return F.coalesce(_col(value), F.lit(False))


def detect_lateral_movement(window_1h_unique_hosts, threshold: int = 10) -> Column:
    return _count(window_1h_unique_hosts) >= F.lit(threshold)


def detect_burst_login(window_1h_event_count, threshold: int = 50) -> Column:
    return _count(window_1h_event_count) >= F.lit(threshold)


def detect_new_device(has_new_device) -> Column:
    return _flag(has_new_device)


def detect_rare_host(has_new_device) -> Column:
    return _flag(has_new_device)


def detect_new_device_spike(has_new_device, window_24h_unique_hosts, threshold: int = 25) -> Column:
    return _flag(has_new_device) & (_count(window_24h_unique_hosts) >= F.lit(threshold))


def fired_flags(rules: Mapping[str, Column]) -> Column:
    """Names of the rules that hold, in the mapping's order; empty array if none."""
    named = [F.when(held, F.lit(name)).otherwise(F.lit("")) for name, held in rules.items()]
    return F.array_remove(F.array(*named), "")


def fired_weight(rules: Mapping[str, Column], weights: Mapping[str, int]) -> Column:
    total = F.lit(0)
    for name, held in rules.items():
        total = total + F.when(held, F.lit(int(weights[name]))).otherwise(F.lit(0))
    return total.cast("int")


def _rules(cfg: RiskConfig, events_1h, hosts_1h, hosts_24h, new_device, popular_rare=None) -> dict:
    rare = detect_rare_host(new_device) if popular_rare is None else _flag(popular_rare)
    held = (
        detect_lateral_movement(hosts_1h, cfg.lateral_movement_unique_hosts_1h),
        detect_burst_login(events_1h, cfg.burst_login_event_count_1h),
        rare,
        detect_new_device_spike(new_device, hosts_24h, cfg.new_device_spike_unique_hosts_24h),
    )
    return dict(zip(RULES, held))


def _weights(cfg: RiskConfig) -> dict:
    return {name: getattr(cfg, f"weight_{name}") for name in RULES}


def compute_risk_score(
    events_1h="window_1h_event_count",
    hosts_1h="window_1h_unique_hosts",
    hosts_24h="window_24h_unique_hosts",
    new_device="has_new_device",
    cfg=None,
    popular_rare=None,
) -> tuple[Column, Column]:
    """``(risk_score, risk_flags)``; NULL inputs count as 0 or false."""
    cfg = RiskConfig.of(cfg)
    rules = _rules(cfg, events_1h, hosts_1h, hosts_24h, new_device, popular_rare)
    return fired_weight(rules, _weights(cfg)), fired_flags(rules)


def apply_risk_engine(df: DataFrame, cfg=None) -> DataFrame:
    """Append ``risk_score`` and ``risk_flags``.

    In popularity mode ``df`` must carry a boolean ``is_rare_host``.
    """
    cfg = RiskConfig.of(cfg)
    rare = F.col("is_rare_host") if cfg.rare_host_mode == "popularity" else None
    score, flags = compute_risk_score(cfg=cfg, popular_rare=rare)
    return df.withColumns({"risk_score": score, "risk_flags": flags})


def risk_level(score="risk_score") -> Column:
    level = None
    for name, top in LEVELS:
        held = _col(score) <= F.lit(top)
        level = F.when(held, name) if level is None else level.when(held, name)
    return level.otherwise("CRITICAL")


def triage_level(score="risk_score") -> Column:
    """Bands closed at the bottom (75, 50, 25), as the triage report has them."""
    s = _col(score)
    return F.when(s >= 75, "CRITICAL").when(s >= 50, "HIGH").when(s >= 25, "MEDIUM").otherwise("LOW")


def indicator_score(weights: Mapping[str, int] = INDICATOR_WEIGHTS) -> Column:
    """Weighted sum of the wide table's 0/1 indicator columns."""
    return fired_weight({name: F.col(name) == 1 for name in weights}, weights)


def evaluate_basic_risk(is_new_device, is_login_burst) -> tuple[Column, Column]:
    """Two-rule ``(score, flags)`` kept for callers of the early scoring form."""
    rules = {"new_device": _flag(is_new_device), "login_burst": _flag(is_login_burst)}
    return fired_weight(rules, BASIC_WEIGHTS), fired_flags(rules)


_SQL_ARGS = (
    "user_id STRING, dst_host STRING, src_host STRING, event_time TIMESTAMP, "
    "events_1h BIGINT, hosts_1h BIGINT, hosts_24h BIGINT, new_device BOOLEAN"
)


def register_risk_functions(spark: SparkSession, cfg=None) -> None:
    """Create the SQL functions ``risk_score`` and ``risk_flags`` (8 arguments each).

    They are SQL-bodied, so Catalyst inlines them; no Python runs per row. The arguments
    tell new devices but not unpopular hosts, so the mode that needs these is refused.
    """
    cfg = RiskConfig.of(cfg)
    if cfg.rare_host_mode != "new_device":
        raise ValueError("the SQL functions know new devices only; use apply_risk_engine for rare hosts by popularity")
    tests = {
        "lateral_movement": f"coalesce(hosts_1h, 0) >= {cfg.lateral_movement_unique_hosts_1h}",
        "burst_login": f"coalesce(events_1h, 0) >= {cfg.burst_login_event_count_1h}",
        "rare_host": "coalesce(new_device, false)",
        "new_device_spike": "coalesce(new_device, false) AND "
        f"coalesce(hosts_24h, 0) >= {cfg.new_device_spike_unique_hosts_24h}",
    }
    weights = _weights(cfg)
    score = " + ".join(f"if({test}, {int(weights[name])}, 0)" for name, test in tests.items())
    flags = ", ".join(f"if({test}, '{name}', '')" for name, test in tests.items())
    for name, returns, body in (
        ("risk_score", "INT", score),
        ("risk_flags", "ARRAY<STRING>", f"array_remove(array({flags}), '')"),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({_SQL_ARGS}) RETURNS {returns} RETURN {body}")
