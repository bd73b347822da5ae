"""Survey microdata weighting and establishment cleaning on Spark DataFrames."""

from tallyweave import functions, operators, plans, sources, streaming

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
