"""gatewatch: authentication-risk analytics written as Spark DataFrame jobs."""

from gatewatch.config import HopSpec, PipelineConfig, RiskConfig, StreamConfig, TablePaths

__all__ = ["HopSpec", "PipelineConfig", "RiskConfig", "StreamConfig", "TablePaths"]
