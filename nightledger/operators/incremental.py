"""Rule 3 kept as a state table that follows the changes.

The rule as reported takes, over all history, the first time a card shows up in
another city within an hour, where every operation stands once for each version
of its terminal. ``fraud3_state`` keeps that time per card and brings it up to
date from two kinds of change: new operations, and new terminal versions, which
put further rows beside old operations.

Both only insert rows into a card's sequence. A pair of neighbours that is new
holds an inserted row, so its event lies within an hour of one. A pair that an
insertion parts has the inserted row between its two times, so where cities are
known one of the two new pairs is an event too, not later than the old one:
the first time can only become earlier, and it is enough to look at the days
within an hour of inserted rows. A row without a city matches nothing and can
take an event away; cards that get such a row are worked out again from all
their days.

What is read: the day's operations, the days on which a terminal with a new
version was used (``terminal_days`` knows them), and of the days around
inserted rows the cards that have some.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.operators.rules import fraud3_events
from nightledger.session import shared_dir

HORIZON = "INTERVAL 1 HOUR"


def terminal_days(ops: DataFrame) -> DataFrame:
    """(terminal, op_date) of every day on which a terminal was used."""
    return ops.where(F.col("terminal").isNotNull() & F.col("op_date").isNotNull()).select("terminal", "op_date").distinct()


def new_versions(before: DataFrame, after: DataFrame) -> DataFrame:
    """(terminal_id, terminal_city, effective_from) of versions that ``before`` does not have."""
    cols = ["terminal_id", "terminal_city", "effective_from"]
    return after.select(*cols).subtract(before.select(*cols))


def _days(df: DataFrame) -> list:
    """The days of ``op_date``, a bounded number: one per day of operations."""
    return [r.op_date for r in df.select("op_date").distinct().collect()]


def fraud3_state(state: DataFrame, fact: DataFrame, today: DataFrame, terminals: DataFrame, fresh: DataFrame,
                 days: DataFrame) -> DataFrame:
    """(card_num, event_dt) after ``today``'s operations and the ``fresh`` terminal versions.

    ``state`` is the table before; ``fact`` holds all operations, today's
    included, by ``op_date``; ``terminals`` all versions, the fresh ones
    included; ``days`` the ``terminal_days`` of ``fact``.
    """
    shared_dir(fact.sparkSession)
    of = fresh.groupBy(F.col("terminal_id").alias("terminal")).agg(F.bool_or(F.col("terminal_city").isNull()).alias("no_city"))
    used = _days(days.join(of, "terminal", "left_semi"))
    cityless = terminals.groupBy(F.col("terminal_id").alias("terminal")).agg(F.bool_or(F.col("terminal_city").isNull()).alias("no_city"))
    inserted = (today.join(cityless, "terminal").select("card_num", "trans_date", "no_city")
                .unionByName(fact.where(F.col("op_date").isin(used)).join(of, "terminal").select("card_num", "trans_date", "no_city")))
    t, hour = F.col("trans_date"), F.expr(HORIZON)
    near = (inserted.where(F.col("card_num").isNotNull() & t.isNotNull())
            .select("card_num", "no_city", F.explode(F.array_distinct(F.array(*[x.cast("date") for x in (t - hour, t, t + hour)]))).alias("op_date"))
            .groupBy("card_num", "op_date").agg(F.bool_or("no_city").alias("no_city")).checkpoint())
    again = near.where("no_city").select("card_num").distinct()
    rows = fact.where(F.col("op_date").isin(_days(near))).join(near, ["card_num", "op_date"], "left_semi")
    found = fraud3_events(rows, terminals)
    met = (state.unionByName(found).groupBy("card_num").agg(F.min("event_dt").alias("event_dt")))
    if again.isEmpty():
        return met
    whole = fraud3_events(fact.join(again, "card_num", "left_semi"), terminals)
    return met.join(again, "card_num", "left_anti").unionByName(whole)
