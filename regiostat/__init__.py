"""Regional public statistics on Spark: sources, cleaning, analytic views, reports and datasets."""

from regiostat.tables import TableSet

__all__ = ["TableSet"]
