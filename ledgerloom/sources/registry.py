"""The registry of ingested files (A4, A5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import truncate_text

FILE_KEY = ["s3_bucket", "s3_key"]


def new_files(listing: DataFrame, registry: DataFrame) -> DataFrame:
    """Listed files without a loaded entry; pending, processing and failed ones come again."""
    loaded = registry.filter(F.col("status") == "loaded").select(*FILE_KEY).distinct()
    return listing.join(loaded, FILE_KEY, "left_anti")


def register_files(listing: DataFrame, registry: DataFrame, as_of: Column) -> DataFrame:
    """The registry with a pending entry for every listed file it does not know yet.

    Ids continue after the highest one without gaps. Files are numbered within parts given by
    a hash of their key, however many lie in one folder; only the sizes of the parts, which
    are at most 4096, are summed up in one task.
    """
    unknown = listing.join(registry.select(*FILE_KEY), FILE_KEY, "left_anti")
    parts = unknown.withColumn("_part", F.left(F.md5(F.col("s3_key").cast("binary")), F.lit(3)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("_part").agg(F.count("*").alias("_files")) \
        .select("_part", F.coalesce(F.sum("_files").over(before), F.lit(0)).alias("_before"))
    in_part = F.row_number().over(Window.partitionBy("_part").orderBy(*FILE_KEY))
    numbered = parts.withColumn("_n", in_part).join(F.broadcast(offsets), "_part") \
        .withColumn("_n", F.col("_n") + F.col("_before"))
    last = F.coalesce(registry.agg(F.max("ingestion_id")).scalar(), F.lit(0))
    added = {
        "ingestion_id": (last + F.col("_n")).cast("long"),
        "status": F.lit("pending"),
        "discovered_at": as_of.cast("timestamp"),
    }
    columns = []
    for field in registry.schema:
        if field.name in added:
            value = added[field.name]
        elif field.name in listing.columns:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return registry.unionByName(numbered.select(*columns))


def registry_transition(registry: DataFrame, events: DataFrame) -> DataFrame:
    """Apply status events (ingestion_id, status, event_ts, rows_loaded, error_message).

    Events of an entry are folded without being put in a list: the latest one gives status,
    end and error, the latest of each kind gives start and row count. ``processing`` clears
    end and error, ``loaded`` clears the error, ``failed`` keeps its text up to the limit.
    """
    def of(status: str, value: str) -> Column:
        return F.when(F.col("status") == status, F.col(value))

    last = F.struct("event_ts", "status")
    folded = events.groupBy("ingestion_id").agg(
        F.max_by(F.struct("status", "event_ts", "error_message"), last).alias("_last"),
        F.max(of("processing", "event_ts")).alias("_started"),
        F.max_by(of("loaded", "rows_loaded"), of("loaded", "event_ts")).alias("_rows"),
    )
    moved = F.col("_last").isNotNull()
    status = F.col("_last.status")
    ended = status.isin("loaded", "failed")
    changes = {
        "status": status,
        "started_at": F.coalesce("_started", "started_at"),
        "finished_at": F.when(ended, F.col("_last.event_ts"))
        .when(status != "processing", F.col("finished_at")),
        "rows_loaded": F.coalesce("_rows", "rows_loaded"),
        "error_message": F.when(status == "failed", truncate_text(F.col("_last.error_message"))),
    }
    joined = registry.join(folded, "ingestion_id", "left")
    return joined.select(*(
        F.when(moved, changes[f.name]).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
        if f.name in changes else F.col(f.name)
        for f in registry.schema
    ))
