"""The registered queries of these operators, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import (
    bagminhash, bitplanes, bytecnn, decontam, differencing, gnat, langid, licenses, line_rules, packing, pii,
    urls, warc)
from ledgerloom.llm.common import table
from ledgerloom.session import shared_dir


LICENSE_TEXTS = licenses.TEMPLATES + licenses.SHORT_NOTICES


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), LICENSE_TEXTS, wrapped=True)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), f"{shared_dir(spark, 'warc')}/archives")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judged(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filtered(table(spark, sf_dir, "pages"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return differencing.extracted(table(spark, sf_dir, "pages"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gnat.coded(table(spark, sf_dir, "embeddings"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.clustered(table(spark, sf_dir, "embeddings"))


def op13_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytecnn.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    build.__name__: build
    for build in (op1_license_scan, op2_warc, op3_packing, op4_quality_rules, op5_language_id, op6_url_filter,
                  op7_pii, op8_html_extraction, op9_minhash_near_dedup, op10_benchmark_decontamination,
                  op11_vector_codes, op12_centroid_clusters, op13_quality_score)
}

#: Where there is none, SQL lacks the tokenizer, the trained model or the search; tests hold those
#: queries against brute force, a round trip or held-out labels.
ORACLES: dict[str, str] = {
    "op1_license_scan": licenses.oracle(LICENSE_TEXTS),
    "op2_warc": warc.ORACLE,
    "op6_url_filter": urls.oracle(),
    "op11_vector_codes": gnat.oracle(),
    "op12_centroid_clusters": bitplanes.oracle(),
}
