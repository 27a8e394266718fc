"""nightledger: a daily bank warehouse load and fraud report on Spark.

Every operator is a plain function ``DataFrame -> DataFrame`` (no hidden
state); the daily job in :mod:`nightledger.plans.pipeline` wires them
together and publishes tables to a Parquet store.
"""

__all__ = ["schemas"]
