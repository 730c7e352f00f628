"""Electricity-demand and large-load analytics as Spark DataFrame operators.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns); nothing is collected.  Clock values are parameters, so a run can be
repeated.  The session time zone must be UTC (see ``gridtide.session``).
"""

__version__ = "0.1.0"
