"""Parquet warehouse of committed attempts.

* Every execution of a run is an attempt with folders of its own,
  ``<table>/attempt=<run>-<id>``: nothing is overwritten, and a plan never
  writes a path that it reads.
* An attempt counts when its one-line marker lands in ``_runs``, written last.
  A marker is named after its run and how many markers the run had when the
  attempt began, and is created only if no file of that name exists: of two
  attempts that began side by side the second to end fails. Of several markers
  of a run the one begun last counts. Readers open only folders of counting
  attempts, so what a crashed attempt has left is never seen.
* History tables are segments: an attempt writes the rows that it closed and
  the rows that are open after it, side by side. Closed rows never change, so
  they are written once and read from the attempts that closed them; of the open
  segments the last one counts. A run reads and writes open rows and changes,
  however long the history is.
* What attempts that do not count have left is removed by ``remove_left_over``.
* State tables (control table, blacklist, first and last operation
  per card, first event of rule 3 per card, days of use per terminal) are written whole; the transactions and the report accumulate: a
  read takes the folders of all counting runs up to the one asked for.
* The transactions of an attempt are partitioned by operation day, so a
  filter on ``op_date`` opens only those days.
* Staged rows of an attempt are tables as well (``stage``), written once and
  then read by everything that needs them.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightledger import schemas as S
from nightledger.operators.scd2 import is_open

HISTORY = {
    "dim_terminals_hist": S.DIM_TERMINALS_HIST,
    "dim_accounts_hist": S.DIM_ACCOUNTS_HIST,
    "dim_cards_hist": S.DIM_CARDS_HIST,
    "dim_clients_hist": S.DIM_CLIENTS_HIST,
}
VERSIONED = {
    "fact_blacklist": S.FACT_BLACKLIST,
    "meta_loading": S.META_LOADING,
    "card_span": T.StructType([T.StructField("card_num", T.StringType()),
                               T.StructField("first_dt", T.TimestampNTZType()),
                               T.StructField("last_dt", T.TimestampNTZType())]),
    "rule3_events": T.StructType([T.StructField("card_num", T.StringType()), T.StructField("event_dt", T.TimestampNTZType())]),
    "terminal_days": T.StructType([T.StructField("terminal", T.StringType()), T.StructField("op_date", T.DateType())]),
}
#: Accumulating tables, with the expression of the day they are partitioned by.
ACCUMULATING = {"fact_transactions": (S.FACT_TRANSACTIONS, "trans_date"), "rep_fraud": (S.REP_FRAUD, None),
                "export_files": (S.EXPORT_FILES, None), "rejects": (S.REJECTS, None), "run_counts": (S.RUN_COUNTS, None)}
RUNS = T.StructType([T.StructField("run", T.IntegerType()), T.StructField("attempt", T.StringType()),
                     T.StructField("business_date", T.TimestampNTZType()), T.StructField("run_ts", T.TimestampNTZType()),
                     T.StructField("committed_at", T.TimestampNTZType())])


#: Names under which an attempt stages rows.
STAGED = ("accounts", "cards", "clients", "terminals", "transactions", "blacklist")
OPEN, CLOSED = "open", "closed"


class AlreadyCommitted(RuntimeError):
    """Another attempt of the run landed its marker first."""


def _file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it names it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file unless it exists; False if it does. Whoever creates it first wins where the file system says so (HDFS does)."""
    fs, target = _file_system(spark, path)
    try:
        out = fs.create(target, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ---- runs and attempts ----
    def runs(self) -> DataFrame:
        """Counting attempts, one row a run."""
        try:
            marks = self.spark.read.schema(RUNS).option("mode", "FAILFAST").json(f"{self.root}/_runs")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise  # unreadable is not empty
            return self.spark.createDataFrame([], RUNS)
        last = F.max(F.struct("attempt", "business_date", "run_ts", "committed_at")).alias("m")  # attempts sort by run and marker
        return marks.groupBy("run").agg(last).select("run", "m.*")

    def _attempts(self, upto: int | None = None) -> dict[int, str]:
        """Counting attempts by run: a row for each day ever loaded."""
        rows = self.runs().select("run", "attempt").collect()
        return {r["run"]: r["attempt"] for r in rows if upto is None or r["run"] <= upto}

    def committed_run(self) -> int | None:
        return max(self._attempts(), default=None)

    def begin(self, run: int) -> str:
        """A new attempt of a run. A run below the last committed one would contradict later ones."""
        last = self.committed_run()
        if last is not None and run < last:
            raise ValueError(f"run {run} cannot be repeated: run {last} is built on it")
        return f"{run:06d}-{self._markers(run):03d}-{uuid.uuid4().hex[:12]}"

    def _markers(self, run: int) -> int:
        """How many markers a run has, those that were never finished too."""
        try:
            files = self.spark.read.format("binaryFile").load(f"{self.root}/_runs").select("path").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0
        return sum(bool(re.search(rf"/{run:06d}-\d+\.json$", f.path)) for f in files)

    def commit(self, attempt: str, business_date: _dt.datetime, run_ts: _dt.datetime) -> None:
        """Land the marker; raises :class:`AlreadyCommitted` if another attempt has done so since this one began."""
        run, marker, _ = attempt.split("-")
        if int(run) < (self.committed_run() or 0):
            raise AlreadyCommitted(f"run {int(run)}: a later run is committed, {attempt} does not count")
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        row = dict(zip(RUNS.names, (int(run), attempt, *(t.isoformat() for t in (business_date, run_ts, now))), strict=True))
        if not create_new(self.spark, f"{self.root}/_runs/{run}-{marker}.json", json.dumps(row) + "\n"):
            raise AlreadyCommitted(f"run {int(run)}: another attempt was committed first, {attempt} does not count")

    # ---- tables ----
    def write(self, df: DataFrame, table: str, attempt: str) -> None:
        """Write a table of this attempt; of a history table the rows that the attempt had open or closed, not those closed before."""
        schema, day = ACCUMULATING.get(table) or (HISTORY.get(table) or VERSIONED[table], None)
        rows = df.select(*[f.name for f in schema.fields])
        path = f"{self.root}/{table}/attempt={attempt}"
        if table in HISTORY:
            segment = F.when(is_open(), F.lit(OPEN)).otherwise(F.lit(CLOSED))
            rows.withColumn("segment", segment).write.partitionBy("segment").parquet(path)
        elif day:
            rows.withColumn("op_date", F.to_date(day)).write.partitionBy("op_date").parquet(path)
        else:
            rows.write.parquet(path)

    def stage(self, df: DataFrame, name: str, attempt: str) -> DataFrame:
        """Rows of this attempt, written once and read back."""
        path = f"{self.root}/_staging/{name}/attempt={attempt}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def read(self, table: str, run: int | None = None, attempt: str | None = None) -> DataFrame:
        """The table as of ``run`` (default: the last committed), and of an open ``attempt`` if given.

        A state table that no run has written is empty.
        """
        known = self._attempts(run)
        if table in HISTORY:
            return self._history(table, known, attempt).select(*HISTORY[table].names)
        if table in VERSIONED:
            of = attempt or (known[max(known)] if known else None)
            return self.empty(table) if of is None else self.spark.read.schema(VERSIONED[table]).parquet(f"{self.root}/{table}/attempt={of}")
        schema, day = ACCUMULATING[table]
        folders = [known[r] for r in sorted(known)] + ([attempt] if attempt else [])
        if not folders:
            return self.empty(table)
        full = T.StructType(list(schema.fields) + ([T.StructField("op_date", T.DateType())] if day else []))
        return (self.spark.read.schema(full).option("basePath", f"{self.root}/{table}")
                .parquet(*[f"{self.root}/{table}/attempt={a}" for a in folders]).select(*full.names))

    def _history(self, table: str, known: dict[int, str], attempt: str | None) -> DataFrame:
        """All closed segments and the last open one, with the column ``segment``."""
        run = int(attempt[:6]) if attempt else max(known, default=0)
        folders = [a for r, a in sorted(known.items()) if r < run or not attempt] + ([attempt] if attempt else [])
        full = T.StructType([*HISTORY[table].fields, T.StructField("attempt", T.StringType()), T.StructField("segment", T.StringType())])
        if not folders:
            return self.spark.createDataFrame([], full)
        rows = (self.spark.read.schema(full).option("basePath", f"{self.root}/{table}")
                .parquet(*[f"{self.root}/{table}/attempt={a}" for a in folders]))
        return rows.where((F.col("segment") == CLOSED) | (F.col("attempt") == folders[-1]))

    def open_rows(self, table: str, run: int | None) -> DataFrame:
        """The open rows of a history table as of ``run``; empty when there is no earlier run."""
        known = {} if run is None else self._attempts(run)
        return self._history(table, known, None).where(F.col("segment") == OPEN).select(*HISTORY[table].names)

    def left_over(self) -> list[str]:
        """Folders of attempts that do not count and no longer can: their run is older than the last committed one, or is
        that run and has a later marker."""
        counting = self._attempts()
        last = max(counting, default=0)
        fs, _ = _file_system(self.spark, self.root)
        out = []
        for table in (*HISTORY, *VERSIONED, *ACCUMULATING, *(f"_staging/{n}" for n in STAGED)):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
            for f in fs.listStatus(path) if fs.exists(path) else []:
                attempt = f.getPath().getName().removeprefix("attempt=")
                run, marker = (int(x) for x in attempt.split("-")[:2])
                done = run < last or run == last and marker < int(counting[last].split("-")[1])
                if done and attempt not in counting.values():
                    out.append(f.getPath().toString())
        return out

    def remove_left_over(self) -> int:
        """Delete what ``left_over`` names; returns how many folders that were."""
        fs, _ = _file_system(self.spark, self.root)
        found = self.left_over()
        for path in found:
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(path), True)
        return len(found)

    def report(self, run: int) -> DataFrame:
        """The report rows that a committed run appended."""
        return self.read("rep_fraud", 0, self._attempts()[run])

    def empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], HISTORY.get(table) or VERSIONED.get(table) or ACCUMULATING[table][0])

    def before(self, table: str, run: int | None) -> DataFrame:
        """State as of run ``run`` exactly; empty when there is no earlier run."""
        return self.empty(table) if run is None else self.read(table, run)
