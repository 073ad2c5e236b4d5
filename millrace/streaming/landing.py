"""Landing only the files that arrived since the last run.

The scheduled form of the batch landing: each run takes the new export files, lands them
and quarantines their violations, then stops. Both steps work row by row, so no state is
kept beyond the list of files seen, which the stream's own checkpoint holds.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace import vocab
from millrace.plans.rules import quarantine_source
from millrace.sources.landing import CORRUPT, csv_options, header_of, ordered, text_schema, uneven, with_lineage


def land_new_files(
    spark: SparkSession, source: str, folder: str, root: str, ingested_at: str, batch_id: str
) -> StreamingQuery:
    """Start a run over the new files in `folder`; it ends by itself.

    Each micro-batch owns one folder per table and replaces it as a whole, so a batch that
    is retried after a failure is stored once. Columns are found by the header of the files at
    hand; a file with another header fails the run. Lines with more or fewer fields than the
    header are stored as they are in a table of their own as well.
    """
    columns = vocab.SOURCE_COLUMNS[source]
    names = header_of(spark, folder, columns)
    files = spark.readStream.schema(text_schema([*names, CORRUPT])).options(**csv_options()).csv(folder)
    landed = with_lineage(files.select(*ordered(names, columns), CORRUPT), ingested_at, batch_id)
    bronze, bad = f"{root}/bronze_{source}", f"{root}/bad_records_{source}"

    def store(batch: DataFrame, epoch: int):
        lines = uneven(batch, F.col("source_file"))
        lines.write.mode("overwrite").parquet(f"{root}/uneven_lines_{source}/epoch={epoch}")
        batch = batch.drop(CORRUPT)
        path = f"{bronze}/epoch={epoch}"
        batch.write.mode("overwrite").parquet(path)
        stored = batch.sparkSession.read.schema(batch.schema).parquet(path)
        found = quarantine_source(stored, source, ingested_at)
        found.write.mode("overwrite").parquet(f"{bad}/epoch={epoch}")

    return (
        landed.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{root}/_progress_{source}")
        .trigger(availableNow=True)
        .start()
    )
