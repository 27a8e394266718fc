"""Consume each export file once.

The source moves loaded files to an archive folder so a later run does not
read them again. Here a file stream with ``trigger(availableNow=True)``
processes everything new since the last run and stops; its checkpoint is
what guarantees exactly-once, and ``cleanSource=archive`` moves files that an
earlier run has committed into the archive folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightledger.schemas import STG_TRANSACTIONS
from nightledger.sources.files import TRANSACTION_FILES, TRANSACTIONS_STEM, business_date, unread_files


def ingest_available_now(spark: SparkSession, src_dir: str, sink_dir: str, checkpoint: str,
                         archive_dir: str | None = None) -> DataFrame:
    """Stage every not-yet-seen transactions file into ``sink_dir`` (Parquet); return the sink.

    Runs until all files are taken, however long that is.
    """
    unread_files(spark, src_dir)
    reader = (spark.readStream.schema(STG_TRANSACTIONS)
              .option("sep", ";").option("header", True)
              .option("recursiveFileLookup", True)
              .option("pathGlobFilter", TRANSACTION_FILES))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    stream = reader.csv(src_dir).withColumn(
        "business_date", business_date(F.col("_metadata.file_path"), TRANSACTIONS_STEM))
    q = (stream.writeStream.format("parquet")
         .option("checkpointLocation", checkpoint)
         .partitionBy("business_date")
         .trigger(availableNow=True)
         .start(sink_dir))
    q.awaitTermination()
    sink_schema = T.StructType(list(STG_TRANSACTIONS.fields)
                               + [T.StructField("business_date", T.TimestampNTZType())])
    return spark.read.schema(sink_schema).parquet(sink_dir)
