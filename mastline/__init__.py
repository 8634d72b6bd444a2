"""Spark-native medallion engine for periodic cell-tower readings."""

from mastline.plans.engine import Engine
from mastline.session import build_session

__all__ = ["Engine", "build_session"]
