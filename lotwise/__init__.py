"""Spark-native operators for high-volume test and measurement tables."""

from lotwise.spec import DRAM, FeatureSpec

__all__ = ["DRAM", "FeatureSpec"]
