"""As-of merge, disjoint versions and hot cards, against plain versions over random overlaps."""

import datetime as dt
import random

from pyspark.sql import functions as F

from nightledger.operators import sequence, strict
from nightledger.operators.asof import as_of, disjoint
from nightledger.schemas import DIM_ACCOUNTS_HIST, DIM_CARDS_HIST, DIM_CLIENTS_HIST, DIM_TERMINALS_HIST, FACT_TRANSACTIONS, MAXD

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def random_versions(rng, keys):
    """Versions of each key: in order, overlapping, nested, equal, empty, without an end or a start."""
    out = []
    for k in range(keys):
        for v in range(rng.randrange(7)):
            a = rng.randrange(0, 6000)
            b = None if rng.random() < 0.05 else MAXD if rng.random() < 0.2 else at(a + rng.choice([-5, 0, 1, 30, 400, 4000]))
            out.append((f"k{k}", at(a) if rng.random() > 0.03 else None, b, rng.choice(["x", "y", None]), v))
    return out


def in_force(versions, key, t):
    """The version that starts last of those in force; ties by end, then by the values, NULL least."""
    held = [v for v in versions if v[0] == key and v[1] is not None and v[2] is not None and v[1] <= t < v[2]]
    return max(held, key=lambda v: (v[1], v[2], v[3] is not None, v[3] or "", v[4]), default=None)


def test_one_row_per_operation_over_random_overlaps(spark):
    rng = random.Random(1)
    versions = random_versions(rng, 150)
    schema = "key string, v_from timestamp_ntz, v_to timestamp_ntz, city string, n int"
    df = spark.createDataFrame(versions, schema).repartition(7)
    flat = disjoint(df, "key", "v_from", "v_to")
    by_key = {}
    for r in flat.collect():
        by_key.setdefault(r.key, []).append((r.v_from, r.v_to))
    for spans in by_key.values():
        spans.sort()
        assert all(a < b for a, b in spans) and all(spans[i][1] <= spans[i + 1][0] for i in range(len(spans) - 1))
    ops = [(i, f"k{rng.randrange(160)}" if rng.random() > 0.02 else None, at(rng.randrange(-100, 9000)) if rng.random() > 0.02 else None) for i in range(4000)]
    ops += [(10_000 + i, v[0], v[1]) for i, v in enumerate(versions)] + [(20_000 + i, v[0], v[2]) for i, v in enumerate(versions)]
    frame = spark.createDataFrame(ops, "id long, key string, t timestamp_ntz")
    for bucket in ("1 DAY", "1 HOUR", "7 DAYS"):
        got = as_of(frame, flat, "key", "t", bucket=bucket).collect()
        assert len(got) == len({r.id for r in got})
        want = {i: in_force(versions, k, t) for i, k, t in ops if k is not None and t is not None}
        assert {r.id: (r.city, r.n) for r in got} == {i: (v[3], v[4]) for i, v in want.items() if v}


def test_two_open_versions_report_an_operation_once(spark):
    """A late change leaves two open rows of an account, a card and a terminal; each operation is still one row."""
    late = [(at(0), MAXD, "N"), (at(60), MAXD, "N")]
    cards = spark.createDataFrame([("c", "a", *v) for v in late], DIM_CARDS_HIST)
    accounts = spark.createDataFrame([("a", at(10), "p", *late[0]), ("a", at(30), "p", *late[1])], DIM_ACCOUNTS_HIST)
    clients = spark.createDataFrame([("p", "L", "F", None, None, "P1", at(-1), "1", *late[0])], DIM_CLIENTS_HIST)
    terminals = spark.createDataFrame([("t", "POS", "A", "x", *late[0]), ("t", "POS", "B", "x", *late[1]), ("u", "POS", "B", "x", *late[0])], DIM_TERMINALS_HIST)
    rows = [(str(i), at(m), "c", "PAY", None, "SUCCESS", k) for i, (m, k) in enumerate([(5, "t"), (50, "t"), (70, "t"), (80, "u"), (90, "t")])]
    fact = spark.createDataFrame(rows, FACT_TRANSACTIONS)
    bl = spark.createDataFrame([], "passport_num string, entry_dt timestamp_ntz")
    assert sorted(r.event_dt for r in strict.fraud1_strict(fact, cards, accounts, clients, bl, T0).collect()) == [r[1] for r in rows]
    # until minute 60 the first account version holds (valid to 10), from then on the second (valid to 30)
    assert sorted(r.event_dt for r in strict.fraud2_strict(fact, cards, accounts, clients, T0).collect()) == [at(m) for m in (50, 70, 80, 90)]
    # the terminal is in A until minute 60, then in B as the other one
    assert [r.event_dt for r in strict.fraud3_strict(fact, terminals, cards, accounts, clients, None, T0).collect()] == [at(70)]


def test_strict_rules_open_recent_days_only(spark, tmp_path):
    fact = spark.createDataFrame([("1", at(0), "c", "PAY", None, "SUCCESS", "t")], FACT_TRANSACTIONS)
    fact.withColumn("op_date", F.to_date("trans_date")).write.partitionBy("op_date").parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    plan = strict._since(stored, at(3000), "20 MINUTES")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(op_date" in plan


LAGS = {"p": ("oper_result", 1), "q": ("trans_date", 2)}


def test_a_hot_card_is_many_buckets_with_equal_rows(spark):
    rng = random.Random(2)
    rows = [(str(i), T0 + dt.timedelta(seconds=rng.randrange(86_400)), "hot", rng.choice("AB")) for i in range(18_000)]
    rows += [(str(20_000 + i), T0 + dt.timedelta(seconds=rng.randrange(3 * 86_400)), f"c{i % 40}", rng.choice("AB")) for i in range(2000)]
    df = spark.createDataFrame(rows, "trans_id string, trans_date timestamp_ntz, card_num string, oper_result string").repartition(8)
    wide = sequence.lagged(df, LAGS, "20 MINUTES")
    narrow = sequence.lagged(df, LAGS, "20 MINUTES", most=1280)
    assert narrow._jdf.queryExecution().executedPlan().toString().count("Window [") == 1
    assert sorted(map(str, narrow.collect())) == sorted(map(str, wide.collect()))
    hot = {r._hot: r._width for r in sequence.hot_widths(df, "card_num", "trans_date", "trans_id", 86_400_000_000, 1_200_000_000, 1280).collect()}
    assert set(hot) == {"hot"} and 86_400_000_000 // hot["hot"] >= 16   # 18,000 rows a day, 1,280 or so a bucket


def test_a_burst_gets_buckets_no_narrower_than_the_horizon(spark):
    rows = [(str(i), T0 + dt.timedelta(milliseconds=i), "hot", "A") for i in range(5000)]   # all within five seconds
    df = spark.createDataFrame(rows, "trans_id string, trans_date timestamp_ntz, card_num string, oper_result string")
    width = sequence.hot_widths(df, "card_num", "trans_date", "trans_id", 86_400_000_000, 3_600_000_000, 640).first()._width
    assert 3_600_000_000 <= width < 2 * 3_600_000_000
    got, want = (sequence.lagged(df, LAGS, "1 HOUR", most=m) for m in (640, None))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
