"""Pick up new export and rate files exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.schemas import (
    ERROR_TEXT_LIMIT, EXPORT_COLUMNS, FILE_REGISTRY, RATE_KEY, RATE_PAYLOAD,
)
from ledgerloom.sources.exports import (
    export_options, file_metadata, read_delimited, with_provenance,
)
from ledgerloom.sources.rates import RECORD_SCHEMA, merge_rates, rate_rows
from ledgerloom.sources.registry import register_files, registry_transition
from ledgerloom.sources.sinks import read_version, write_partitions, write_version

MAX_FILES = 1000


def _headers(spark: SparkSession, paths: list[str], encoding: str, delimiter: str, quote: str) -> DataFrame:
    """Column names in the first line of each file, read from the first split of it; of a file that
    is not UTF-8 by the reader of whole files."""
    if encoding.upper().replace("-", "") == "UTF8":
        lines = spark.read.text(paths).filter(F.col("_metadata.file_block_start") == 0)
        names = F.split(F.replace(F.replace("value", F.lit("\ufeff"), F.lit("")), F.lit(quote), F.lit("")),
                        f"\\x{{{ord(delimiter):x}}}")
    else:
        lines = spark.read.options(**export_options(encoding, delimiter, quote) | {"header": False}).csv(paths)
        names = F.array(*(F.coalesce(c, F.lit("")) for c in lines.columns))
    order = F.monotonically_increasing_id()
    return lines.select(F.col("_metadata.file_path").alias("s3_key"), order.alias("_n"), names.alias("_names")) \
        .groupBy("s3_key").agg(F.min_by("_names", "_n").alias("_names")) \
        .select("s3_key", F.transform("_names", F.btrim).alias("headers"))


def _land(
    session: SparkSession, files: DataFrame, paths: list[str], headers: tuple, raw_path: str, as_of: Column,
    loaded_by: str, reader: dict,
) -> None:
    """Write the rows of files (s3_key, ingestion_id) that have one header as raw partitions."""
    rows = read_delimited(session, paths, list(headers), **reader).select(
        *(F.coalesce(F.col(f"`{h}`"), F.lit("")).alias(c) for h, c in EXPORT_COLUMNS.items()), "source_file")
    ids = files.select(F.col("s3_key").alias("source_file"), "ingestion_id")
    landed = rows.join(F.broadcast(ids), "source_file")
    write_partitions(with_provenance(landed, F.col("ingestion_id"), as_of, loaded_by), raw_path, ["ingestion_id"])


def stream_ingest(
    spark: SparkSession,
    inbox: str,
    raw_path: str,
    registry_path: str,
    checkpoint: str,
    source: tuple[str, str, str],
    as_of: Column,
    loaded_by: str = "ledgerloom",
    files_per_batch: int = MAX_FILES,
    multiline: bool = True,
    pattern: str = "*.csv",
    encoding: str = "UTF-8",
    delimiter: str = ",",
    quote: str = '"',
) -> StreamingQuery:
    """Land all new export files as raw batches, one ingestion id per file, then stop.

    The stream is one of files, so that files without rows are seen too. Files are entered in the
    same registry, by the same functions, as those of single loads. UTF-8 files are read in splits.
    A file that lacks a column, has no rows or cannot be read is marked ``failed`` and passed over:
    files of one header are landed together, and one by one if that fails. A micro-batch writes the registry version that
    bears its own number, built from the version before, and raw partitions are replaced, so one
    that is repeated gives the same tables. The registry is written last: rows without a loaded
    entry are never read.
    """
    if files_per_batch < 1:
        raise ValueError("files_per_batch must be at least 1")
    system, name, table = source
    text = {"encoding": encoding, "delimiter": delimiter, "quote": quote}

    def land(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        paths = [r.s3_key for r in batch.select("s3_key").collect()]  # at most files_per_batch
        if not paths:
            return
        entries, _ = read_version(session, registry_path, FILE_REGISTRY, below=batch_id + 1)
        sums = file_metadata(session, paths).select(F.col("_file").alias("s3_key"), "file_checksum")
        listing = batch.join(sums, "s3_key", "left").select(
            F.lit(inbox).alias("s3_bucket"), "s3_key", "file_size_bytes", "file_checksum",
            F.lit(system).alias("source_system"), F.lit(name).alias("source_object"),
            F.lit(table).alias("raw_table"),
        )
        known = register_files(listing, entries, as_of).persist()
        own = known.join(F.broadcast(batch.select("s3_key")), "s3_key", "left_semi") \
            .filter(F.col("s3_bucket") == inbox)
        required = F.array(*map(F.lit, EXPORT_COLUMNS))
        checked = own.select("s3_key", "ingestion_id").join(_headers(session, paths, **text), "s3_key", "left") \
            .withColumn("missing", F.array_sort(F.array_except(
                required, F.coalesce("headers", F.array().cast("array<string>"))))).persist()
        good = checked.filter("size(missing) = 0").select("s3_key", "ingestion_id", "headers").collect()
        reader, unread = text | {"multiline": multiline}, []
        for headers in {tuple(r.headers) for r in good}:
            files = [r.s3_key for r in good if tuple(r.headers) == headers]
            try:
                _land(session, checked, files, headers, raw_path, as_of, loaded_by, reader)
            except Exception:  # noqa: BLE001 - which file it is shows when each is read alone
                for file in files:
                    try:
                        _land(session, checked, [file], headers, raw_path, as_of, loaded_by, reader)
                    except Exception as error:  # noqa: BLE001 - on record in the registry
                        unread.append((file, str(error)[:ERROR_TEXT_LIMIT]))
        outcome = checked.join(F.broadcast(session.createDataFrame(unread, "s3_key string, unread string")),
                               "s3_key", "left")
        if len(unread) < len(good):
            counts = session.read.parquet(raw_path).filter(F.col("ingestion_id").isin([r.ingestion_id for r in good])) \
                .groupBy("ingestion_id").agg(F.count("*").alias("rows_loaded"))
            outcome = outcome.join(counts, "ingestion_id", "left")
        else:
            outcome = outcome.withColumn("rows_loaded", F.lit(None).cast("long"))
        error = F.when(F.size("missing") > 0, F.concat(F.lit("export lacks columns: "), F.array_join("missing", ", "))) \
            .when(F.col("unread").isNotNull(), F.col("unread")) \
            .when(F.col("rows_loaded").isNull(), "export has no data rows")
        ends = outcome.select(
            F.col("ingestion_id").cast("long").alias("ingestion_id"),
            F.when(error.isNull(), "loaded").otherwise("failed").alias("status"),
            as_of.cast("timestamp").alias("event_ts"), F.when(error.isNull(), F.col("rows_loaded")).alias("rows_loaded"),
            error.alias("error_message"),
        )
        starts = ends.select("ingestion_id", F.lit("processing").alias("status"), "event_ts",
                             F.lit(None).cast("long").alias("rows_loaded"),
                             F.lit(None).cast("string").alias("error_message"))
        moved = registry_transition(registry_transition(known, starts), ends)
        write_version(moved, registry_path, batch_id + 1)
        checked.unpersist()
        known.unpersist()

    files = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary"
    ).options(maxFilesPerTrigger=files_per_batch, pathGlobFilter=pattern).load(inbox).select(
        F.col("_metadata.file_path").alias("s3_key"), F.col("length").alias("file_size_bytes"))
    return (
        files.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_upsert_rates(
    spark: SparkSession,
    inbox: str,
    table_path: str,
    checkpoint: str,
    catalog: DataFrame,
    as_of: Column,
    source: str = "cbr",
    loaded_by: str = "ledgerloom",
    files_per_batch: int = MAX_FILES,
) -> StreamingQuery:
    """Merge new rate documents (folders ``currency=XXX``) into the rate table, then stop.

    Documents may overlap earlier ones, and may come out of order: for each rate the state store keeps
    the row of the document written last, whichever micro-batch brought it, and only rates that
    a micro-batch touched leave the state. Of those, unchanged ones stay, and years with a
    corrected or new rate are written anew. A micro-batch is the table's write that bears its own number,
    built from the write before, so repeating it gives the same table.
    """
    records = spark.readStream.format("xml").option("rowTag", "Record").option(
        "maxFilesPerTrigger", files_per_batch
    ).schema(RECORD_SCHEMA + ", currency STRING").load(inbox).select(
        "*", F.col("_metadata.file_modification_time").alias("_modified")
    )
    order = F.struct("_modified", *RATE_PAYLOAD)
    last = rate_rows(records, catalog, source).groupBy(*RATE_KEY).agg(
        F.max_by(F.struct("_modified", *RATE_PAYLOAD), order).alias("_last")
    ).select(*RATE_KEY, "_last.*")

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_rates(batch.sparkSession, table_path, batch, ["_modified", *RATE_PAYLOAD], batch_id + 1, as_of,
                    loaded_by)

    return (
        last.writeStream.outputMode("update").foreachBatch(merge)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
