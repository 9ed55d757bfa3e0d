"""strataflow: layered warehouse analytics written directly on Spark DataFrames."""

from strataflow.config import WarehouseConfig
from strataflow.session import build_session, tune

__all__ = ["WarehouseConfig", "build_session", "tune"]
