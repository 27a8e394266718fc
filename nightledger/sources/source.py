"""Source tables of the operational database as partitioned reads.

``read_options`` is everything that ``spark.read.format("jdbc")`` gets for one
source table; it is separate so that it can be looked at without a database.
The change filter of :mod:`nightledger.operators.cdc` is plain comparisons, so
Spark pushes it into the source's query by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nightledger.schemas import SRC_ACCOUNTS, SRC_CARDS, SRC_CLIENTS

TABLES = {"accounts": SRC_ACCOUNTS, "cards": SRC_CARDS, "clients": SRC_CLIENTS}


def read_options(dim: str, url: str, table: str, partition_column: str | None = None, bounds: tuple[str, str] | None = None,
                 partitions: int = 16, fetch_size: int = 10_000, **extra: str) -> dict[str, str]:
    """Options of a partitioned read; ``bounds`` only place the partitions, rows outside them are read too."""
    if dim not in TABLES:
        raise ValueError(f"no source table for {dim}")
    columns = ", ".join(f.name for f in TABLES[dim].fields)
    out = {"url": url, "dbtable": f"(SELECT {columns} FROM {table}) src", "fetchsize": str(fetch_size),
           "pushDownPredicate": "true", "preferTimestampNTZ": "true"}
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs bounds")
        out |= {"partitionColumn": partition_column, "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": str(partitions)}
    return out | extra


def read_source(spark: SparkSession, dim: str, **options) -> DataFrame:
    """A source table in the column order of its contract."""
    rows = spark.read.format("jdbc").options(**read_options(dim, **options)).load()
    return rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in TABLES[dim].fields])
