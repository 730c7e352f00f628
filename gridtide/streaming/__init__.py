"""Live demand, anomalies and prices; the same functions serve batch and stream."""

from . import live, run, stateful

__all__ = ["live", "run", "stateful"]
