"""Sales-performance analytics expressed as Spark DataFrame transformations."""

from salescope.config import AnalysisConfig, Thresholds

__all__ = ["AnalysisConfig", "Thresholds"]
