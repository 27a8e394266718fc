"""Daily export files: transactions text, terminal and blacklist workbooks.

File names carry the business date (``terminals_DDMMYYYY.xlsx``); it is read
per row from the file path, so many days can be loaded in one scan and
ordered by date.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightledger.functions.scalar import parse_ddmmyyyy
from nightledger.schemas import STG_BLACKLIST, STG_TERMINALS, STG_TRANSACTIONS
from nightledger.sources.workbook import read_workbooks, xlsx_bytes

# Export file name stems.
TRANSACTIONS_STEM = "transactions"
TERMINALS_STEM = "terminals"
BLACKLIST_STEM = "passport_blacklist"


def _any_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


# a transactions file: by its own name, or a part file in a folder of that name
TRANSACTION_FILES = f"{{{_any_case(TRANSACTIONS_STEM)}*,part-*}}"
_IS_TRANSACTIONS = rf"(?i)(^|/)({TRANSACTIONS_STEM}[^/]*|(file=)?{TRANSACTIONS_STEM}[^/]*/part-[^/]*)$"


def unread_files(spark: SparkSession, path: str) -> None:
    """Raise if a file under ``path`` is not a transactions file, instead of passing it over."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path"))
    other = listed.where(~F.url_decode("path").rlike(_IS_TRANSACTIONS)).take(3)
    if other:
        raise ValueError(f"not transactions files: {', '.join(r.path for r in other)}")


def business_date(path: Column, stem: str) -> Column:
    """``<stem>_DDMMYYYY`` in the path, in any case -> timestamp_ntz (NULL if absent).

    The last one counts: a file's own name before the folders it lies in.
    """
    token = F.regexp_extract(path, rf"(?i).*{stem}_(\d{{8}})", 1)
    return F.when(token != "", parse_ddmmyyyy(token))


#: The line as it stands, where it has not as many fields as there are columns.
MALFORMED = "_malformed"


def read_transactions(spark: SparkSession, path: str, with_date: bool = False, malformed: bool = False) -> DataFrame:
    """``;``-separated text with a header, bound to the 7 staging columns by position.

    Every file under ``path`` is read; one that is no transactions file raises.
    With ``malformed`` there is a further column, the whole line where it is
    too short or too long.
    """
    unread_files(spark, path)
    schema = T.StructType([*STG_TRANSACTIONS.fields, *([T.StructField(MALFORMED, T.StringType())] if malformed else [])])
    df = (spark.read.schema(schema).option("columnNameOfCorruptRecord", MALFORMED)
          .option("sep", ";").option("header", True).option("recursiveFileLookup", True)
          .option("pathGlobFilter", TRANSACTION_FILES)
          .csv(path))
    if with_date:
        df = df.withColumn("business_date",
                           business_date(F.col("_metadata.file_path"), TRANSACTIONS_STEM))
    return df


def read_terminals(spark: SparkSession, path: str, with_date: bool = False) -> DataFrame:
    """Terminal snapshot workbook(s): 4 text columns."""
    df = read_workbooks(spark, path, STG_TERMINALS, with_path=with_date)
    if with_date:
        df = df.withColumn("business_date", business_date(F.col("source_file"), TERMINALS_STEM)) \
               .drop("source_file")
    return df


def read_blacklist(spark: SparkSession, path: str) -> DataFrame:
    """Passport blacklist workbook(s), all text: (report_dt, passport_num)."""
    return read_workbooks(spark, path, STG_BLACKLIST)


# ---- writers that turn derived tables into export files (test inputs) ----

def write_transaction_files(stg: DataFrame, out_dir: str) -> str:
    """One ``transactions_DDMMYYYY`` folder per operation day, ``;`` text with a header."""
    day = F.date_format(F.to_timestamp_ntz(F.substring("trans_date", 1, 10)), "ddMMyyyy")
    (stg.withColumn("file", F.concat(F.lit(f"{TRANSACTIONS_STEM}_"), day))
        .write.mode("overwrite").partitionBy("file")
        .option("sep", ";").option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(out_dir))
    return out_dir


def write_workbooks(df: DataFrame, out_dir: str, stem: str, key: str, rows_per_file: int = 5000) -> None:
    """Write rows as workbooks ``<stem>_<number>.xlsx`` of about ``rows_per_file`` rows.

    Rows are dealt to files by a hash of ``key``, so the files are written by
    many tasks, through the file system that ``out_dir`` names.
    """
    from nightledger.session import ship_package
    ship_package(df.sparkSession)
    cols = df.columns
    files = max(1, -(-df.count() // rows_per_file))

    def write(pdf):
        import pandas as pd
        from pyarrow import fs
        system, base = fs.FileSystem.from_uri(re.sub("^file:/*", "file:///", out_dir))
        system.create_dir(base, recursive=True)
        name = f"{stem}_{int(pdf['_file'].iloc[0]):06d}.xlsx"
        rows = pdf[cols].astype(object).where(pdf[cols].notna(), None).values.tolist()
        with system.open_output_stream(f"{base}/{name}") as out:
            out.write(xlsx_bytes(cols, rows))
        return pd.DataFrame({"file": [name], "rows": [len(rows)]})

    dealt = df.withColumn("_file", F.pmod(F.xxhash64(key), F.lit(files)).cast("int"))
    dealt.groupBy("_file").applyInPandas(write, "file string, rows long").write.format("noop").mode("overwrite").save()
