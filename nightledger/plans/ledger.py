"""Admission of daily exports: what was loaded is not loaded again.

Every committed run has the fingerprints of the files it loaded in the ledger
table ``export_files``. Before a run stages anything, its business date is
looked up: a date that is loaded already is the same export if its files hold
the same lines and workbooks, whatever they are called and wherever they lie;
then there is nothing to do. Another content under a loaded date, and a date
older than the last loaded one, are refused by name: history, watermarks and
the report would be built in the wrong order.

Text files are compared by their number of lines and the sum of the lines'
64-bit hashes, one pass that combines on the map side and needs no order;
workbooks by the SHA-256 of the file. A date that is new costs no read here.
"""

from __future__ import annotations

import datetime as _dt
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.functions.scalar import ts_lit
from nightledger.sources.files import TRANSACTION_FILES

if TYPE_CHECKING:
    from nightledger.plans.pipeline import DayInputs
    from nightledger.plans.store import Warehouse


class Refused(ValueError):
    """An export that must not be loaded into this warehouse."""


def _lines(spark: SparkSession, path: str, kind: str) -> DataFrame:
    text = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", TRANSACTION_FILES).text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")))
    return (text.groupBy("file", "bytes")
            .agg(F.count(F.lit(1)).alias("lines"), F.sum(F.xxhash64("value").cast("decimal(38,0)")).alias("sum"))
            .select(F.lit(kind).alias("kind"), "file", "bytes", "lines", F.col("sum").cast("string").alias("digest")))


def _books(spark: SparkSession, path: str, kind: str) -> DataFrame:
    book = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return book.select(F.lit(kind).alias("kind"), F.col("path").alias("file"), F.col("length").alias("bytes"),
                       F.lit(None).cast("long").alias("lines"), F.sha2("content", 256).alias("digest"))


def fingerprints(spark: SparkSession, inp: DayInputs, day: _dt.datetime) -> DataFrame:
    """(business_date, kind, file, bytes, lines, digest) of every file of an export."""
    found = (_lines(spark, inp.transactions, "transactions").unionByName(_books(spark, inp.terminals, "terminals"))
             .unionByName(_books(spark, inp.blacklist, "blacklist")))
    return found.select(ts_lit(day).alias("business_date"), *found.columns)


def differing(loaded: DataFrame, found: DataFrame) -> list[str]:
    """Up to three files of either side whose content the other side has not, as often."""
    same = ["kind", "lines", "digest"]

    def counted(df, n):
        return df.groupBy(*same).agg(F.count(F.lit(1)).alias(n), F.min("file").alias(f"{n}_file"))
    a, b = counted(loaded, "was"), counted(found, "now").select(*[F.col(c).alias(f"_{c}") for c in same], "now", "now_file")
    met = a.join(b, (a.kind == b._kind) & a.lines.eqNullSafe(b._lines) & (a.digest == b._digest), "full")
    other = met.where(~F.col("was").eqNullSafe(F.col("now"))).select(F.coalesce("now_file", "was_file").alias("file"))
    return [r.file.rsplit("/", 1)[-1] for r in other.orderBy("file").take(3)]


def admit(wh: Warehouse, inp: DayInputs, day: _dt.datetime, replacing: int | None = None) -> int | None:
    """The committed run that holds this export already, or None if it may be loaded; else :class:`Refused`.

    ``replacing`` is the run that the caller loads anew and thus does not count.
    """
    dates = {r.business_date: r.run for r in wh.runs().select("run", "business_date").collect() if r.run != replacing}
    if day in dates:
        loaded = wh.read("export_files").where(F.col("business_date") == ts_lit(day))
        other = differing(loaded, fingerprints(wh.spark, inp, day))
        if other:
            raise Refused(f"the export of {day:%Y-%m-%d} is loaded (run {dates[day]}) with other content than {', '.join(other)}")
        return dates[day]
    if dates and day < max(dates):
        raise Refused(f"the export of {day:%Y-%m-%d} is older than the last one loaded, of {max(dates):%Y-%m-%d}")
    return None
