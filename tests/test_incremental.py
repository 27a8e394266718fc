"""Rule 3's state table equals the rule over all history, day by day, with late operations and new terminal versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from nightledger.operators import incremental, rules
from nightledger.schemas import DIM_TERMINALS_HIST, FACT_TRANSACTIONS, MAXD

T0 = dt.datetime(2024, 1, 1)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_state_equals_the_rule_over_random_days(spark, tmp_path, seed):
    rng, versions, n = random.Random(seed), [], 0
    state = spark.createDataFrame([], "card_num string, event_dt timestamp_ntz")
    days = spark.createDataFrame([], "terminal string, op_date date")
    before = spark.createDataFrame([], DIM_TERMINALS_HIST)
    for day in range(4):
        start = T0 + dt.timedelta(days=day)
        for t in range(12):
            if day == 0 or rng.random() < 0.15:   # a new version: another city, the same one, or none
                versions.append((f"t{t}", "POS", rng.choice(["A", "B", None] if seed == 1 and day == 2 else ["A", "B", "C"]), "x", start, MAXD, "N"))
        ops = []
        for _ in range(150):
            late = rng.random() < 0.1   # some belong to a day that was loaded before, some hours cross midnight
            when = start - dt.timedelta(days=rng.randrange(1, 3)) if late else start
            n += 1
            time = None if rng.random() < 0.02 else when + dt.timedelta(minutes=rng.choice([rng.randrange(1440), rng.randrange(1400, 1440), rng.randrange(40)]))
            ops.append((str(n), time, rng.choice([None, *[f"c{i}" for i in range(14)]]), "PAY", None, "SUCCESS", rng.choice([None, *[f"t{i}" for i in range(14)]])))
        (spark.createDataFrame(ops, FACT_TRANSACTIONS).withColumn("op_date", F.to_date("trans_date"))
         .write.mode("append").partitionBy("op_date").parquet(str(tmp_path / "fact")))
        fact = spark.read.parquet(str(tmp_path / "fact")).select(*FACT_TRANSACTIONS.names, "op_date")
        today = fact.where(F.col("trans_id").cast("int") > n - 150)
        after = spark.createDataFrame(versions, DIM_TERMINALS_HIST)
        days = days.unionByName(incremental.terminal_days(today)).distinct()
        made = incremental.fraud3_state(state, fact, today, after, incremental.new_versions(before, after), days)
        want = rules.fraud3_events(fact.where(F.col("card_num").isNotNull()), after)
        assert rows(made) == rows(want), (seed, day)
        state, before = spark.createDataFrame(made.collect(), state.schema), after
    assert state.count() > 5


def test_a_quiet_day_reads_that_day_only(spark, tmp_path):
    ops = [(str(i), T0 + dt.timedelta(hours=5 + 24 * i), "c", "PAY", None, "SUCCESS", "t") for i in range(6)]
    spark.createDataFrame(ops, FACT_TRANSACTIONS).withColumn("op_date", F.to_date("trans_date")).write.partitionBy("op_date").parquet(str(tmp_path / "f"))
    fact = spark.read.parquet(str(tmp_path / "f"))
    ter = spark.createDataFrame([("t", "POS", "A", "x", T0, MAXD, "N")], DIM_TERMINALS_HIST)
    made = incremental.fraud3_state(spark.createDataFrame([], "card_num string, event_dt timestamp_ntz"), fact, fact.where("trans_id = '5'"), ter,
                                    incremental.new_versions(ter, ter), incremental.terminal_days(fact))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "op_date" in plan and "2024-01-06" in plan and not any(f"2024-01-0{d}" in plan for d in range(1, 6))
    assert made.count() == 0
