"""The operators with production parameters, each applied to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.llm import collocations, host_rank, mix, sql, warc
from orebelt.llm.decontaminate import find_leaks
from orebelt.llm.filter_audit import audit_filters
from orebelt.llm.fingerprint import edit_and_compare
from orebelt.llm.host_rank import Rule
from orebelt.llm.main_text import main_text
from orebelt.llm.near_dedup import near_duplicates
from orebelt.llm.ngram_lm import score_texts
from orebelt.llm.pieces import encode, load_pieces
from orebelt.llm.repeats import remove_repeats
from orebelt.llm.toxicity import score_toxicity
from orebelt.session import new_scratch

RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]

PASSAGE_WORDS = 51


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_and_compare(table(spark, sf_dir, "documents"))


def op2_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op3_host_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rank.judge_urls(table(spark, sf_dir, "pages"), RULES)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_scratch(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    captures = warc.merge_runs(warc.read_runs(spark, folder))
    return captures.withColumnRenamed("record_id", "page_id").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = main_text(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Repeated passages of over 50 words may be shorter than the strings that are removed: they are told apart.
    found = remove_repeats(table(spark, sf_dir, "documents"), words=PASSAGE_WORDS, keep_passages=True)
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        "n_passage_bytes", "n_passages",
    )


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode(table(spark, sf_dir, "documents"), load_pieces(), decoded=True)
    return coded.select("doc_id", "ids", F.size("ids").alias("n_pieces"), F.sha2("text", 256).alias("decoded_sha256"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix.mix_sources(table(spark, sf_dir, "documents"))
    taken = mix.words_taken(F.col("size"), F.col("passes"), F.col("spans"))
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprint": op1_fingerprint,
    "op2_ngram_lm": op2_ngram_lm,
    "op3_host_rank": op3_host_rank,
    "op4_warc": op4_warc,
    "op5_toxicity": op5_toxicity,
    "op6_main_text": op6_main_text,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_near_dedup": op8_near_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_pieces": op10_pieces,
    "op11_collocations": op11_collocations,
    "op12_mix": op12_mix,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op3_host_rank": sql.host_rank(RULES),
    "op4_warc": sql.WARC,
    "op11_collocations": sql.collocations(collocations.LEAST, collocations.TOP),
    "op12_mix": sql.mix(mix.WEIGHTS, mix.MOST, mix.BLOCK_WORDS, mix.SHARD_WORDS, mix.SHARD_ROWS, mix.SEED),
    "op13_filter_audit": sql.FILTER_AUDIT,
}
