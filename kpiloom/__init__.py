"""kpiloom: market KPIs, export, streaming alerts and revenue model on Spark."""

__version__ = "0.1.0"
