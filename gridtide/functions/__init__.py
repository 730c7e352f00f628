"""Column-level building blocks; all run inside the JVM."""

from . import exact, geo, lookups, scalar

__all__ = ["exact", "geo", "lookups", "scalar"]
