"""shelfline: retail batch and near-real-time analytics as Spark DataFrame jobs.

Every operator is a function ``f(df, ..., params) -> DataFrame`` that only
builds a lazy logical plan; Catalyst and AQE choose the physical strategy.
"""

__version__ = "0.1.0"
