"""Delimited ledger exports and the files they come in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.schemas import EXPORT_COLUMNS
from ledgerloom.sources.records import split_records

CHECKSUM_PRIME = 2 ** 61 - 1


def export_options(
    encoding: str = "UTF-8", delimiter: str = ",", quote: str = '"', multiline: bool = True
) -> dict:
    """CSV options of an export: columns by header, quotes doubled inside quoted values."""
    return {
        "header": True, "enforceSchema": False, "encoding": encoding, "sep": delimiter,
        "quote": quote, "escape": quote, "multiLine": multiline, "mode": "PERMISSIVE",
    }


def require_columns(found: list[str], columns: dict[str, str] = EXPORT_COLUMNS) -> None:
    """Fail with the names of the export columns that are not there."""
    missing = sorted(set(columns) - set(found))
    if missing:
        raise ValueError("export lacks columns: " + ", ".join(missing))


def export_headers(
    spark: SparkSession, path: str | list[str], encoding: str = "UTF-8", delimiter: str = ",", quote: str = '"',
) -> list[str]:
    """Names in the first record of the first file; none if it is empty."""
    options = export_options(encoding, delimiter, quote) | {"header": False}
    first = spark.read.options(**options).csv(path).first()
    return [(name or "").removeprefix("\ufeff") for name in first or []]


def read_delimited(
    spark: SparkSession, path: str | list[str], headers: list[str], encoding: str = "UTF-8",
    delimiter: str = ",", quote: str = '"', multiline: bool = True, split: bool = True,
) -> DataFrame:
    """All columns of exports with these headers, as text, with ``source_file``. UTF-8 files are read
    in splits; others, and those that cannot be, by one task each if values may hold line breaks."""
    found = None
    if split and multiline and encoding.upper().replace("-", "") == "UTF8":
        found = split_records(spark, path, headers, delimiter, quote)
    if found is None:
        found = spark.read.options(**export_options(encoding, delimiter, quote, multiline)).csv(path) \
            .withColumn("source_file", F.col("_metadata.file_path"))
    return found


def read_ledger_export(
    spark: SparkSession,
    path: str,
    encoding: str = "UTF-8",
    delimiter: str = ",",
    quote: str = '"',
    columns: dict[str, str] = EXPORT_COLUMNS,
    multiline: bool = True,
    split: bool = True,
) -> DataFrame:
    """Read exports as text under their raw column names, with the name of each row's file.

    Values stay as they are and other columns are dropped; a missing column or an export
    without rows is an error. ``multiline`` allows line breaks inside quoted values. A UTF-8 file
    is read in as many tasks as it has splits; ``split=False`` reads each file by one task.
    """
    headers = export_headers(spark, path, encoding, delimiter, quote)
    require_columns(headers, columns)
    export = read_delimited(spark, path, headers, encoding, delimiter, quote, multiline, split)
    if export.isEmpty():
        raise ValueError("export has no data rows")
    return export.select(
        *(F.coalesce(F.col(f"`{name}`"), F.lit("")).alias(raw) for name, raw in columns.items()),
        "source_file",
    )


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, size and modification time of all files under a folder; reads no content."""
    return spark.read.format("binaryFile").options(
        recursiveFileLookup=True, pathGlobFilter=pattern
    ).load(path).select("path", "modificationTime", "length")


def latest_file(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One row about the most recently modified file (all NULL if there is none)."""
    newest = F.max_by(F.struct("path", "modificationTime", "length"),
                      F.struct("modificationTime", "path"))
    return list_files(spark, path, pattern).agg(newest.alias("f")).select("f.*")


def latest_file_path(spark: SparkSession, path: str, pattern: str = "*") -> str:
    """Path of the most recently modified file; an error if there is none."""
    found = latest_file(spark, path, pattern).first().path
    if found is None:
        raise ValueError(f"no files under {path}")
    return found


def file_metadata(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    """Path, size and checksum per file, by one definition at every size; ``_file`` is the path as
    file metadata has it.

    Lines end at a line feed and are hashed as bytes. The checksum covers size, number of lines,
    and for two hashes their sum and the sum of hash times line number, modulo a prime. So it sees
    every byte and the order of lines; tasks read splits of a file, and how it was split does not
    matter: numbers within a split are shifted by the lines before it afterwards.
    """
    options = {"recursiveFileLookup": True, "pathGlobFilter": pattern}
    files = spark.read.format("binaryFile").options(**options).load(path).select(
        "path", F.col("_metadata.file_path").alias("_file"), "length")
    wide = "decimal(38,0)"

    def modulo(value: Column) -> Column:
        return F.pmod(value.cast(wide), F.lit(CHECKSUM_PRIME).cast(wide)).cast("decimal(19,0)")

    digest = F.md5(F.col("value").cast("binary"))
    parts = {k: F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(19,0)")
             for k, at in (("a", 1), ("b", 16))}
    number = F.monotonically_increasing_id()
    lines = spark.read.options(**options).option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"),
        number.alias("_n"), *(h.alias(f"_{k}") for k, h in parts.items()),
    )
    splits = lines.groupBy("_file", "_at").agg(
        F.min("_n").alias("_first"), F.count("*").alias("_lines"),
        *(F.sum(f"_{k}").cast(wide).alias(f"_sum_{k}") for k in parts),
        *(F.sum(modulo(F.col("_n").cast("decimal(19,0)") * F.col(f"_{k}"))).cast(wide)
          .alias(f"_by_n_{k}") for k in parts),
    )
    # One row per split of a file: few, however large the file.
    before = Window.partitionBy("_file").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_lines").over(before), F.lit(0)) - F.col("_first")
    shifted = splits.withColumn("_shift", modulo(shift))
    sums = shifted.groupBy("_file").agg(
        F.sum("_lines").alias("_lines"),
        *(modulo(F.sum(f"_sum_{k}")).alias(f"_s_{k}") for k in parts),
        *(modulo(F.sum(modulo(F.col("_shift") * modulo(F.col(f"_sum_{k}"))) + modulo(F.col(f"_by_n_{k}"))))
          .alias(f"_w_{k}") for k in parts),
    )
    facts = [F.col("length"), F.coalesce("_lines", F.lit(0)),
             *(F.coalesce(f"_{kind}_{k}", F.lit(0).cast("decimal(19,0)")) for k in parts for kind in "sw")]
    return files.join(sums, "_file", "left").select(
        "path", "_file", F.col("length").alias("file_size_bytes"),
        F.md5(F.concat_ws(":", *(f.cast("string") for f in facts)).cast("binary")).alias("file_checksum"),
    )


def with_provenance(
    rows: DataFrame, ingestion_id: Column, as_of: Column, loaded_by: str,
    source_file: Column | None = None,
) -> DataFrame:
    """Add batch, time and loader to landed rows, and a number unique within the batch."""
    added = {
        "raw_id": F.monotonically_increasing_id(),
        "ingested_at": as_of.cast("timestamp"),
        "ingested_by": F.lit(loaded_by),
        "ingestion_id": ingestion_id.cast("long"),
    }
    if source_file is not None:
        added["source_file"] = source_file
    return rows.withColumns(added)


def append_raw(rows: DataFrame, path: str) -> int:
    """Write landed rows, one partition per batch, and return how many there were.

    A batch that is written again after a failure replaces what it had written, so it is
    never there twice. Rows are counted while they are written.
    """
    counted = Observation("append_raw")
    (
        rows.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingestion_id").parquet(path)
    )
    return counted.get["rows"]


def read_seed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Typed reference rows from a CSV file; a value that does not fit its type is an error."""
    return spark.read.schema(schema).options(
        header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True,
        mode="FAILFAST", enforceSchema=False,
    ).csv(path)
