"""Staging text -> typed facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.functions.scalar import decimal_comma, parse_dt, strip_blanks


def clean_transactions(stg: DataFrame) -> DataFrame:
    """Parse date and amount, strip card blanks; project to the fact layout."""
    return stg.select(
        F.col("trans_id"),
        parse_dt("trans_date").alias("trans_date"),
        strip_blanks("card_num").alias("card_num"),
        F.col("oper_type"),
        decimal_comma("amt").alias("amt"),
        F.col("oper_result"),
        F.col("terminal"),
    )


def _bad(text: str, value) -> Column:
    """The input has text that is not blank, and no value came of it."""
    return (F.trim(F.coalesce(F.col(text), F.lit(""))) != "") & value.isNull()


def rejects(stg: DataFrame) -> DataFrame:
    """Transactions whose amount or time is neither blank nor readable, with the reason.

    They reach the fact with NULL there; this table says what was lost.
    """
    why = F.concat_ws(", ", F.when(_bad("trans_date", parse_dt("trans_date")), "trans_date"),
                      F.when(_bad("amt", decimal_comma("amt")), "amt"))
    return stg.withColumn("reason", why).where(F.col("reason") != "")


def rejected_lines(transactions: DataFrame, blacklist: DataFrame) -> DataFrame:
    """(source, id, line, reason) of everything in the staged rows that could not be read as it should.

    Lines with another number of fields (column ``_malformed``) are not loaded;
    rows with a text that is no time or amount are, with NULL in its place.
    """
    bad = rejects(transactions.where(F.col("_malformed").isNull()).drop("_malformed"))
    fields = [c for c in bad.columns if c != "reason"]
    named = lambda source: F.lit(source).alias("source")
    return (transactions.where(F.col("_malformed").isNotNull())
            .select(named("transactions"), F.lit(None).cast("string").alias("id"), F.col("_malformed").alias("line"), F.lit("malformed").alias("reason"))
            .unionByName(bad.select(named("transactions"), F.col("trans_id").alias("id"), F.concat_ws(";", *fields).alias("line"), "reason"))
            .unionByName(blacklist.where(_bad("report_dt", parse_dt("report_dt")))
                         .select(named("blacklist"), F.col("passport_num").alias("id"), F.concat_ws(";", "report_dt", "passport_num").alias("line"),
                                 F.lit("report_dt").alias("reason"))))


def clean_blacklist(stg: DataFrame) -> DataFrame:
    """Blacklist rows: passport and the date it was listed."""
    return stg.select(F.col("passport_num"), parse_dt("report_dt").alias("entry_dt"))


def scalar_cleaning(stg: DataFrame) -> DataFrame:
    """Every cleaning function at once, next to its input text (for checks)."""
    from nightledger.functions.scalar import fio
    return stg.select(
        "trans_id",
        strip_blanks("card_num").alias("card_clean"),
        F.replace(F.col("amt"), F.lit(","), F.lit(".")).alias("amt_dot"),
        F.trim(F.col("card_num")).alias("card_trim"),
        decimal_comma("amt").alias("amt_num"),
        parse_dt("trans_date").alias("trans_ts"),
        parse_dt(F.substring("trans_date", 1, 10)).alias("trans_day"),
        fio(F.col("oper_type"), F.lit(None).cast("string"), F.col("terminal")).alias("fio_like"),
    )
