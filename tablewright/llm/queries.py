"""The queries of the corpus operators over whole tables, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql
from .common import table
from .decontamination import decontamination
from .fill_in_middle import fill_in_middle
from .importance_resampling import importance_resampling
from .license_scan import license_scan
from .line_dedup import line_dedup
from .ngram_jaccard import ngram_jaccard
from .personal_data import personal_data
from .quality_classifier import quality_classifier
from .quality_rules import quality_rules
from .secret_scan import secret_scan
from .source_mixing import source_mixing
from .token_counts import token_counts
from .url_filters import host_of, url_filters

TOKENIZER = "word_bpe_49k.json"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.round(c, 6) for c in ("word_distance", "class_distance")})


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages has neither dates nor a list, so both are derived from its own values: a day of 2024 from each page's id, and
    four dated entries, in turn block and allow, for a quarter of the hosts, besides three entries of whole domains."""
    number = lambda c: F.conv(F.substring(F.md5(c.cast("string")), 1, 6), 16, 10).cast("long")
    first = F.lit("2024-01-01").cast("date")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.date_add(first, (number(F.col("page_id")) % 365).cast("int")).alias("fetched"))
    hosts = pages.select(host_of(F.col("url")).alias("domain")).dropna().distinct().withColumn("x", number(F.col("domain"))).where("x % 4 = 0")
    dated = hosts.select("domain", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"), "x").select(
        "domain", F.when(F.col("k") % 2 == 0, "block").otherwise("allow").alias("action"), F.date_add(first, (F.col("x") % 90 + 90 * F.col("k")).cast("int")).alias("since")
    )
    whole = spark.sql("SELECT * FROM VALUES ('example.net', 'block', DATE '2024-03-01'), ('example.net', 'allow', DATE '2024-06-01'), ('example.org', 'allow', DATE '2024-01-01') AS t(domain, action, since)")
    return url_filters(pages, dated.unionByName(whole)).withColumn("fetched", F.col("fetched").cast("string"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing(table(spark, sf_dir, "documents")).withColumn("probability", F.round("probability", 6))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # of the vocabulary files; other tokenizer files need no such package

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_line_dedup": op2_line_dedup,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_decontamination": op4_decontamination,
        "op5_url_filters": op5_url_filters,
        "op6_source_mixing": op6_source_mixing,
        "op7_ngram_jaccard": op7_ngram_jaccard,
        "op8_token_counts": op8_token_counts,
        "op9_license_scan": op9_license_scan,
        "op10_secret_scan": op10_secret_scan,
        "op11_fill_in_middle": op11_fill_in_middle,
        "op12_importance_resampling": op12_importance_resampling,
        "op13_personal_data": op13_personal_data,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": sql.quality_rules_sql(),
        "op2_line_dedup": sql.line_dedup_sql(),
        "op4_decontamination": sql.decontamination_sql(),
        "op5_url_filters": sql.url_filters_sql(),
        "op6_source_mixing": sql.source_mixing_sql(),
        "op7_ngram_jaccard": sql.ngram_jaccard_sql(),
        "op10_secret_scan": sql.secret_scan_sql(),
        "op11_fill_in_middle": sql.fill_in_middle_sql(),
        "op12_importance_resampling": sql.importance_resampling_sql(),
        "op13_personal_data": sql.personal_data_sql(),
    }
