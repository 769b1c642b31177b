"""envgrade: environmental sensor analytics on Spark, batch and streaming."""

from envgrade.config import Settings, Stretch
from envgrade.session import build_session

__all__ = ["Settings", "Stretch", "build_session"]
