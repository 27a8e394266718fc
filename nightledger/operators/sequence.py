"""Per-card LAG that stays balanced when one card holds a large share of rows.

``LAG(x, k) OVER (PARTITION BY card ORDER BY time, ...)`` puts every row of
a card into one task. The fraud rules only ever use a lag under a
"within <horizon>" test, so each row only needs its predecessors of the last
``horizon``. Rows are therefore partitioned by ``(card, time bucket)`` and
each row is also copied, as context, into the next bucket when it lies
within ``horizon`` of that bucket's start. Inside a bucket the rows form a
contiguous time interval ``[start - horizon, end)``, so a computed lag equals
the true lag whenever the true lag is within the horizon, and is NULL or
older otherwise. Lag values older than ``horizon`` are then masked to NULL,
which makes the result independent of the bucket width (and equal to a
plain window with the same mask).

Cost: one exchange on ``(card, bucket)``, one sort, one Window node, plus
``horizon / bucket`` extra rows (4 % for 1 hour in 1-day buckets).

A card that has very many rows in one bucket gets narrower buckets of its own
(``hot_widths``): the width is halved until none of the card's buckets holds
more than a given number of rows, and never below the horizon. Which cards
those are is read off the rows whose hash falls below a threshold; a wrong
estimate makes a task larger or smaller and changes no result, as results do
not depend on the width.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows of a card in one bucket from which its buckets are made narrower: what one task sorts in memory.
HOT_ROWS = 500_000

# horizon strings accepted by the rules -> timedelta
_UNITS = {"SECOND": "seconds", "SECONDS": "seconds", "MINUTE": "minutes", "MINUTES": "minutes",
          "HOUR": "hours", "HOURS": "hours", "DAY": "days", "DAYS": "days"}


def to_timedelta(spec: str | _dt.timedelta) -> _dt.timedelta:
    if isinstance(spec, _dt.timedelta):
        return spec
    n, unit = spec.split()
    return _dt.timedelta(**{_UNITS[unit.upper()]: int(n)})


def _micros(td: _dt.timedelta) -> int:
    return (td.days * 86400 + td.seconds) * 1_000_000 + td.microseconds


def _wall_micros(t: Column) -> Column:
    """Microseconds since 1970-01-01 of a zone-free timestamp, from its date and clock fields.

    Built from calendar fields so the session time zone (and its DST jumps)
    can never bend the bucket grid.
    """
    days = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    clock = (F.hour(t) * 3600 + F.minute(t) * 60).cast("long") * 1_000_000
    secs = (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long")
    return days * 86_400_000_000 + clock + secs


def bucket_width(bucket: str | _dt.timedelta) -> int:
    """Microseconds of a bucket."""
    return _micros(to_timedelta(bucket))


def bucket_start(t: Column, width: int) -> Column:
    """The start of the bucket of ``width`` microseconds that a zone-free time lies in."""
    day = t.cast("date").cast("timestamp_ntz")
    if width % 86_400_000_000 == 0 and width > 86_400_000_000:
        back = F.pmod(F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")), F.lit(width // 86_400_000_000))
        return day - F.make_dt_interval(back.cast("int"))
    if 86_400_000_000 % width:
        raise ValueError("a bucket is a whole number of days or divides one")
    within_day = F.pmod(_wall_micros(t), F.lit(86_400_000_000))
    secs = (F.floor(within_day / width) * width).cast("decimal(20,6)") / 1_000_000
    return day + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs.cast("decimal(18,6)"))


def hot_widths(df: DataFrame, key: str, time: str, id_col: str, bucket: int, horizon: int, most: int, share: int = 64) -> DataFrame:
    """(key, width) in microseconds for keys with over ``most`` rows in a bucket.

    Counts come from about one in ``share`` rows, chosen by a hash of time and
    id and thus the same at every evaluation; only keys that are that frequent
    in it leave the aggregation.
    """
    least = max(1, most // share)
    picked = df.where(F.col(key).isNotNull() & (F.pmod(F.xxhash64(time, id_col), F.lit(share)) == 0))
    levels = 0
    while bucket >> (levels + 1) >= horizon and not (bucket >> levels) % 2:
        levels += 1
    fine = bucket >> levels
    slots = picked.select(key, F.floor(_wall_micros(F.col(time)) / F.lit(fine)).alias("_slot")).groupBy(key, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    # how many rows the fullest bucket of each width holds: width bucket >> level, level 0 the widest
    at = slots.select(key, "_n", F.posexplode(F.array(*[F.floor(F.col("_slot") / F.lit(1 << (levels - j))) for j in range(levels + 1)])).alias("_level", "_w"))
    full = at.groupBy(key, "_level", "_w").agg(F.sum("_n").alias("_n")).where(F.col("_n") > least)
    # levels that are too full for a key; a narrower bucket is too full only if all wider ones are
    worst = full.groupBy(key).agg(F.max("_level").alias("_worst"))
    level = F.least(F.col("_worst") + 1, F.lit(levels))
    return worst.select(F.col(key).alias("_hot"), F.element_at(F.array(*[F.lit(bucket >> j) for j in range(levels + 1)]), level + 1).alias("_width"))


def trans_order(time: str = "trans_date", id_col: str = "trans_id",
                tie_breakers: list[str] | tuple[str, ...] = ()) -> list[Column]:
    """Total order used for every LAG: time (NULLs last), numeric id, id, extra keys.

    Expects the numeric id materialized as column ``_oid`` (see :func:`with_order_id`),
    so every window using this order shares one sort.
    """
    return ([F.col(time).asc_nulls_last(), F.col("_oid").asc_nulls_last(),
             F.col(id_col).asc_nulls_last()]
            + [F.col(c).asc_nulls_last() for c in tie_breakers])


def with_order_id(df: DataFrame, id_col: str = "trans_id") -> DataFrame:
    return df.withColumn("_oid", F.expr(f"try_cast({id_col} AS BIGINT)"))


def lagged(df: DataFrame, lags: dict[str, tuple[str, int]], horizon: str | _dt.timedelta,
           key: str = "card_num", time: str = "trans_date", id_col: str = "trans_id",
           tie_breakers: list[str] | tuple[str, ...] = (),
           bucket: str | _dt.timedelta | None = "1 DAY", most: int | None = None) -> DataFrame:
    """Add ``name = LAG(col, k)`` for each ``name: (col, k)``; lags older than ``horizon`` are NULL.

    ``bucket=None`` uses a plain window over the whole card (exact, but one
    task per card); any bucket at least as wide as ``horizon`` gives the
    same rows. A key with more than about ``most`` rows in a bucket gets
    narrower ones (without a ``most`` none does). All lags share one window
    specification, so the plan has one exchange, one sort and one Window node.
    """
    h = to_timedelta(horizon)
    t = F.col(time)
    offsets = sorted({k for _, k in lags.values()})
    x = with_order_id(df, id_col)
    order = trans_order(time, id_col, tie_breakers)
    if bucket is None:
        w = Window.partitionBy(key).orderBy(*order)
    else:
        b = to_timedelta(bucket)
        if b < h:
            raise ValueError("bucket must be at least as wide as the horizon")
        bm, hm = _micros(b), _micros(h)
        tm = _wall_micros(t)
        wide = F.lit(bm)
        if most is not None:
            hot = hot_widths(df, key, time, id_col, bm, hm, most)
            x = x.join(hot, F.col(key) == F.col("_hot"), "left").drop("_hot")
            wide = F.coalesce("_width", F.lit(bm))
        own = F.floor(tm / wide)
        last = F.floor((tm + F.lit(hm)) / wide)
        # a row belongs to its own bucket and is context for the next one when
        # it lies within the horizon of that bucket's start (NULL time: own only)
        x = (x.withColumn("_own", own)
              .withColumn("_b", F.explode_outer(F.sequence(F.col("_own"), last))))
        w = Window.partitionBy(key, "_b").orderBy(*order)
    base = [F.col(c) for c in x.columns]
    x = x.select(*base,
                 *[F.lag(t, k).over(w).alias(f"_lt{k}") for k in offsets],
                 *[F.lag(F.col(col), k).over(w).alias(name) for name, (col, k) in lags.items()])
    if bucket is not None:
        x = x.where(F.col("_b").eqNullSafe(F.col("_own"))).drop("_b", "_own", "_width")
    floor = t - F.expr(f"INTERVAL {int(h.total_seconds())} SECONDS")
    masked = {name: F.when(F.col(f"_lt{k}") >= floor, F.col(name)).alias(name)
              for name, (_, k) in lags.items()}
    keep = [c for c in x.columns if c not in masked and not c.startswith("_lt") and c != "_oid"]
    return x.select(*[F.col(c) for c in keep], *masked.values())
