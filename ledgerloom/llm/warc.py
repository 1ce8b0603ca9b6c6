"""WARC archives with revisit records.

Pages become headers (id, size, digest of the payload). Headers are grouped by digest; of equal
payloads of at least ``MIN_REVISIT_BYTES`` bytes the page with the smallest id keeps its payload as a
response record, the others become revisit records that refer to it. Records get fresh headers and
are written as archives; read back, revisit records are resolved by joining them to the responses
they name.

An archive is a text file whose lines are records: WARC records end with two line breaks, the last of
which the writer adds. So archives are written and read by Spark itself, in any store it knows, and
a task that is run again replaces its own file.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import sized, stored

MIN_REVISIT_BYTES = 100
#: Archives hold about this many bytes of payload, so that one is no burden to the task that reads it.
ARCHIVE_BYTES = 16 << 20
WARC_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def headers(pages: DataFrame) -> DataFrame:
    """Each page with payload (none for a revisit), payload_bytes, payload_digest and, by digest,
    record_type and refers_to. Null html is an empty payload."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    named = pages.select("page_id", "url", payload.alias("payload"),
                         F.octet_length(payload).cast("long").alias("payload_bytes"),
                         F.sha2(payload, 256).alias("payload_digest"))
    # Only digests that occur more than once need a join; the counts are summed before the shuffle.
    shared = (named.filter(F.col("payload_bytes") >= MIN_REVISIT_BYTES).groupBy("payload_digest")
              .agg(F.min("page_id").alias("original"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    # Payloads move only if there are too many such digests to send them to every task.
    joined = named.join(sized(shared, shared.count(), 160), "payload_digest", "left")
    again = F.col("page_id") != F.col("original")
    return joined.select(
        "page_id", "url", F.when(again, "").otherwise(F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("original")).alias("refers_to"))


def _uri(url: Column) -> Column:
    """A url fit for a header line: no control characters or spaces."""
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7F]", "%20")


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def records(headed: DataFrame) -> DataFrame:
    """One string per record, up to its last line break but one."""
    end = "\r\n"
    response = F.concat(F.lit(f"HTTP/1.1 200 OK{end}Content-Type: text/html; charset=utf-8{end}Content-Length: "),
                        F.col("payload_bytes").cast("string"), F.lit(end * 2))
    is_revisit = F.col("record_type") == "revisit"
    block = F.concat(response, F.col("payload"))
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))),
        F.lit(f"WARC-Date: {WARC_DATE}"), F.concat(F.lit("WARC-Target-URI: "), _uri(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
        F.when(is_revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to")))),
        F.when(is_revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return headed.select(F.concat(F.concat_ws(end, *lines), F.lit(end * 2), block, F.lit(end)).alias("value"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Deduplicated archives of ``pages`` (page_id, url, html) under ``path``."""
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    parts = max(1, -(-total // ARCHIVE_BYTES))
    place = F.xxhash64("page_id", "url", "payload_digest")
    dealt = records(headers(pages).repartition(int(parts), place))
    dealt.write.mode("overwrite").option("lineSep", "\r\n").option("compression", "gzip").text(path)


_HEAD = re.compile(rb"WARC/1\.[01]\r\n((?:[^\r\n]+\r\n)+)\r\n")
FIELDS = ("page_id long, record_type string, stated_digest string, refers_to long, url string, "
          "payload_bytes long, payload_digest string")


def parse(archive: bytes) -> Iterator[tuple]:
    """Rows of FIELDS, one per record; a record that breaks the format raises."""
    at, view = 0, memoryview(archive)
    while at < len(archive):
        head = _HEAD.match(archive, at)
        if not head:
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                      for line in head[1].decode().split("\r\n")[:-1])
        size = int(fields["Content-Length"])
        block = view[head.end():head.end() + size]
        at = head.end() + size + 4
        if len(block) < size or bytes(view[at - 4:at]) != b"\r\n\r\n":
            raise ValueError(f"record of {size} bytes is not ended at byte {at}")
        body = archive.index(b"\r\n\r\n", head.end(), head.end() + size) + 4 - head.end()
        number = {k: v[len("<urn:page:"):-1] for k, v in fields.items() if v.startswith("<urn:page:")}

        def page(name: str) -> int | None:
            return int(number[name]) if number.get(name, "none") != "none" else None

        original = fields["WARC-Type"] == "response"
        payload = block[body:]
        yield (page("WARC-Record-ID"), fields["WARC-Type"],
               fields["WARC-Payload-Digest"].removeprefix("sha256:"), page("WARC-Refers-To"),
               fields["WARC-Target-URI"], len(payload) if original else None,
               hashlib.sha256(payload).hexdigest() if original else None)


def _parse_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import gzip

    names = [c.split()[0] for c in FIELDS.split(", ")]
    for frame in batches:
        for content in frame["content"]:
            rows = pd.DataFrame(list(parse(gzip.decompress(content))), columns=names)
            yield rows.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives under ``path``, revisits resolved: payload size and digest of a revisit
    are those that the response it names was found to have."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    found = stored(files.select("content").mapInPandas(_parse_files, FIELDS), "records")
    originals = (found.filter("record_type = 'response' AND page_id IS NOT NULL")
                 .groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("stated_digest"))
                 .agg(F.min("payload_bytes").alias("original_bytes")))
    revisits = (found.filter("record_type = 'revisit'")
                .join(originals, ["refers_to", "stated_digest"], "left")
                .select("page_id", "url", F.col("original_bytes").alias("payload_bytes"),
                        F.when(F.col("original_bytes").isNotNull(), F.col("stated_digest")).alias("payload_digest"),
                        "record_type", "refers_to"))
    kept = found.filter("record_type <> 'revisit'").select(
        "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return kept.unionByName(revisits)


def round_trip(pages: DataFrame, path: str) -> DataFrame:
    """Write the archives, read them back: page_id, payload_bytes, payload_digest, record_type,
    refers_to, one row per row of ``pages``.

    Null html is an empty payload; payloads below the limit are all responses. Rows of one page_id
    with equal payloads stay responses, as no other page could be referred to; a null page_id is
    kept. An empty table gives no rows; other columns are not read.
    """
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path).drop("url")


ORACLE = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES}
                     THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM m"""
