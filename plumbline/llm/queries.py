"""Registered queries of the numbered operators, each over its whole table, and SQL that gives the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (alignment, bpe_codec, decontaminate, filter_audit, html_text, line_dedup, ngram_join, quality_rules, sharding, source_mix,
                           token_counts, url_filters, warc)
from plumbline.llm.oracles import SQL  # noqa: F401
from plumbline.llm.shared import importable, table

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
SECOND_TOKENIZER = "piece_bpe_32k.model"


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures of every document and the verdict of the risk-controlled rules."""
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    docs = table(spark, sf_dir, "documents")
    count = token_counts.token_count(F.col("text"), public_tokenizers.path(TOKENIZER))
    return docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), count.alias("n_tokens")) \
        .withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return source_mix.mixed_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to archives and read back. Revisits tell length and digest of the payload they stand for."""
    records = warc.round_trip(table(spark, sf_dir, "pages"))
    full = F.col("record_type") == "response"
    return records.select("page_id", F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
                          F.when(full, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
                          "record_type", "refers_to")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that every document loses to line deduplication, and what stays."""
    rows = line_dedup.line_bitmaps(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(F.col("row.doc_id").alias("doc_id"), line_dedup.line_digest("row.text", "bitmap").alias("d")).select("doc_id", "d.*")


def ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under similarity of 5-word shingles."""
    return ngram_join.similar_classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.sharded(table(spark, sf_dir, "documents")).withColumn("law", F.lit("key"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures of the pages: fetched at a time of the years 2023 and 2024 that the page's id decides."""
    years = F.lit(2 * 365 * 86400)
    seconds = F.pmod(F.pmod(F.col("page_id"), years) * 7919 * 3607, years)
    return pages.select(F.col("page_id").alias("capture"), "url", F.timestamp_seconds(F.lit(1672531200) + seconds).alias("fetched"))


def changes_of(pages: DataFrame) -> DataFrame:
    """Dated changes of two lists, for every host of the pages: when they come is decided by a digest of the host."""
    hosts = pages.select(url_filters.host_of(F.col("url")).alias("host")).where("host IS NOT NULL").distinct()
    digit = lambda i: F.conv(F.substring(F.md5(F.col("host").cast("binary")), i, 3), 16, 10).cast("long")     # noqa: E731
    at = lambda days: F.timestamp_seconds(F.lit(1672531200) + days * 86400)       # noqa: E731
    parent = F.substring_index("host", ".", -3)
    entry = lambda name, key, days, action, verdict: F.struct(      # noqa: E731
        F.lit(name).alias("list"), key.alias("key"), at(days).alias("at"), F.lit(action).alias("action"), F.lit(verdict).alias("verdict"))
    first, second, third = digit(1) % 300, F.lit(1) + digit(4) % 200, F.lit(1) + digit(7) % 200
    entries = F.array(entry("hosts", F.col("host"), first, "add", "block"), entry("hosts", F.col("host"), first + second, "remove", "block"),
                      entry("hosts", F.col("host"), first + second + third, "add", "block"),
                      entry("domains", parent, digit(10) % 400, "add", "watch"), entry("paths", F.concat("host", F.lit("/en")), second + third, "add", "allow"))
    return hosts.where(digit(13) % 2 == 0).select(F.explode(entries).alias("e")).select("e.*")


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's capture against the list entries active when it was fetched."""
    pages = table(spark, sf_dir, "pages")
    found = url_filters.decisions(captures_of(pages), changes_of(pages))
    return found.select(F.col("capture").alias("page_id"), "n_active", F.col("key").alias("entry"), "verdict", "blocked")


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.page_texts(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the tokens that two tokenizers give every document, and how common the linked pairs of ids are."""
    found = alignment.alignments(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.path(SECOND_TOKENIZER))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return alignment.scored(found.withColumn("groups_sha256", digest).drop("groups")) \
        .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every document and of the text that they decode to."""
    found = bpe_codec.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), decode=True)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def filter_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove of the documents, in every order."""
    return filter_audit.document_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _whole(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _whole(query) for name, query in {
    "op1_quality_rules": quality, "op2_token_counts": tokens, "op3_source_mix": mix, "op4_decontamination": contaminated,
    "op5_warc": archives, "op6_line_dedup": lines, "op7_ngram_join": ngrams, "op8_sharding": shards, "op9_url_filters": urls,
    "op10_html_text": page_text, "op11_token_alignment": token_groups, "op12_bpe_codec": token_ids, "op13_filter_audit": filter_orders,
}.items()}
