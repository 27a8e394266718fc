"""As-of join over versions: which version of a key was in force at a time.

``disjoint`` turns the versions of a key into intervals that do not overlap:
where several are in force, the one that starts last wins (then the one that
ends last, then the greater values, so the order is total), and an earlier one
is in force again after a later one has ended before it. Where no version
outlives one that starts after it, this is a ``lead`` over the key's versions;
keys with such versions go through a sweep over their sorted versions that
holds the versions in force and nothing else.

``as_of`` merges operations and intervals by time instead of matching each
operation with all versions of its key: both are one sequence per key, and an
operation takes the last interval that started before it. Keys are cut into time
buckets so that a busy key is many tasks: first each bucket that has operations
gets the interval in force at its start (one row per key and bucket), then
operations meet it and the intervals that start inside the bucket. So an
operation has one row of the result at most, whatever the versions look like.
"""

from __future__ import annotations

import datetime as _dt
import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightledger.operators.sequence import bucket_start, bucket_width
from nightledger.session import ship_package


def disjoint(versions: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """``versions`` as intervals [start, end) of which no two of a key overlap.

    Versions without a key, start or end, or that end before they begin, are
    never in force and have no interval.
    """
    rest = [c for c in versions.columns if c not in (key, start, end)]
    order = [F.col(c) for c in (start, end, *rest)]
    held = versions.where(F.col(key).isNotNull() & (F.col(start) < F.col(end)))
    by_start = Window.partitionBy(key).orderBy(*order)
    longest = F.max(end).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    seen = held.select("*", F.lead(start).over(by_start).alias("_next"), (longest > F.col(end)).alias("_within"))
    seen = seen.withColumn("_nested", F.coalesce(F.bool_or("_within").over(Window.partitionBy(key)), F.lit(False)))
    until = F.least(F.col(end), F.col("_next"))   # least skips NULL
    plain = (seen.where(~F.col("_nested")).withColumn(end, until).where(F.col(start) < F.col(end)).select(*versions.columns))
    return plain.unionByName(_swept(seen.where("_nested").select(*versions.columns), key, start, end, order))


def _swept(versions: DataFrame, key: str, start: str, end: str, order: list) -> DataFrame:
    """Intervals of keys with versions that outlive later ones, from a sweep over sorted rows."""
    ship_package(versions.sparkSession)
    names = versions.columns
    k, s, e = (names.index(c) for c in (key, start, end))

    def pieces(group):
        """The group's rows come by start; the heap's first row is the one that started last of those in force."""
        active, out, at = [], [], None

        def until(t):
            nonlocal at
            while active and (t is None or at < t):
                row = active[0][1]
                if row[e] <= at:
                    heapq.heappop(active)
                    continue
                to = row[e] if t is None else min(row[e], t)
                out.append((*row[:s], at, *row[s + 1:e], to, *row[e + 1:]) if s < e else (*row[:e], to, *row[e + 1:s], at, *row[s + 1:]))
                at = to
        for i, row in enumerate(group):
            until(row[s])
            at = row[s]
            heapq.heappush(active, (-i, row))
        until(None)
        return out

    def sweep(batches):
        import pyarrow as pa
        from itertools import groupby
        left, kinds = [], None   # rows of a key that may go on in the next batch

        def done(rows):
            cols = zip(*rows, strict=True) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kinds, strict=True)], schema=kinds)
        for batch in batches:
            kinds = batch.schema
            rows = left + list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            groups = [list(g) for _, g in groupby(rows, key=lambda r: r[k])]
            left = groups.pop() if groups else []
            yield done([p for g in groups for p in pieces(g)])
        if kinds is not None:
            yield done(pieces(left))
    spread = versions.repartition(key).sortWithinPartitions(key, *order)
    return spread.mapInArrow(sweep, versions.schema)


def as_of(ops: DataFrame, versions: DataFrame, key: str, time: str, start: str = "v_from", end: str = "v_to",
          bucket: str | _dt.timedelta = "1 DAY") -> DataFrame:
    """Each of ``ops`` whose time lies in an interval of its key, with the columns of that interval.

    ``versions`` are disjoint intervals of ``key``; operations without a key,
    time or interval in force have no row.
    """
    values = [c for c in versions.columns if c not in (key, start, end)]
    width = bucket_width(bucket)
    known = ops.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select("*", bucket_start(F.col(time), width).alias("_b"))
    interval = F.struct(*[F.col(c) for c in (start, end, *values)]).alias("_v")
    of = versions.select(key, F.col(start).alias("_t"), interval)
    none = F.lit(None).cast(of.schema["_v"].dataType)
    in_force = F.last("_v", ignorenulls=True)

    # the interval in force at the start of every bucket that has operations
    starts = known.select(key, "_b").distinct().select(key, F.col("_b").alias("_t"), none.alias("_v"), F.lit(1).alias("_kind"))
    by_key = Window.partitionBy(key).orderBy("_t", "_kind")
    at_start = (starts.unionByName(of.withColumn("_kind", F.lit(0)))
                .select(key, "_t", "_kind", in_force.over(by_key).alias("_v"))
                .where((F.col("_kind") == 1) & (F.col(f"_v.{end}") > F.col("_t")))
                .select(key, F.col("_t").alias("_b"), "_t", "_v"))
    inside = of.select(key, bucket_start(F.col("_t"), width).alias("_b"), "_t", "_v")
    cols = [c for c in ops.columns if c != key]
    empty = F.lit(None).cast(known.select(F.struct(*cols).alias("x")).schema["x"].dataType)
    both = (known.select(key, "_b", F.col(time).alias("_t"), none.alias("_v"), F.struct(*cols).alias("_op"), F.lit(1).alias("_kind"))
            .unionByName(at_start.unionByName(inside).withColumn("_op", empty).withColumn("_kind", F.lit(0))))
    by_bucket = Window.partitionBy(key, "_b").orderBy("_t", "_kind")
    met = both.select(key, "_t", "_op", "_kind", in_force.over(by_bucket).alias("_v"))
    met = met.where((F.col("_kind") == 1) & (F.col("_t") < F.col(f"_v.{end}")))
    return met.select(key, *[F.col(f"_op.{c}").alias(c) for c in cols], *[F.col(f"_v.{c}").alias(c) for c in values])
