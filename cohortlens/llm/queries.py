"""The registered queries of the operators in this subpackage, and SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import decontaminate, lbl_model, mixing, page_diff, prefix_tree_join, repetition, secret_scan, sharding, simhash_trie, string_kernel, token_alignment, url_filter, whitening
from cohortlens.llm.tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function
    return register


@query("op2_shard")
def op2_shard(spark, sf_dir):
    """Every document's shard and slot; row counts of the 40 shards differ by one at most."""
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"))
    placed = sharding.shard_rows(docs, [F.col("doc_id")], shards=40, seed=2)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op8_mix", mixing.MIX_SQL)
def op8_mix(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


@query("op4_ngram_join")
def op4_ngram_join(spark, sf_dir):
    return prefix_tree_join.similar_groups(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op10_language")
def op10_language(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return string_kernel.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


@query("op7_decontaminate")
def op7_decontaminate(spark, sf_dir):
    """Every place where a document holds a near copy of a benchmark item."""
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op9_repetition")
def op9_repetition(spark, sf_dir):
    judged = repetition.judge(read(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered", "longest_repeat")


@query("op3_secrets")
def op3_secrets(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.scan(docs, secret_scan.fit(docs)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov")


@query("op5_page_text")
def op5_page_text(spark, sf_dir):
    return page_diff.extract(read(spark, sf_dir, "pages"))


URL_RULES = [url_filter.Rule("org/", "allow"), url_filter.Rule("example.org/es/", "block"), url_filter.Rule("example.org/en/1", "block"),
             url_filter.Rule("com/fr/", "allow"), url_filter.Rule("com/de/", "block")]


@query("op1_url_filter")
def op1_url_filter(spark, sf_dir):
    judged = url_filter.judge_urls(read(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "bad_odds")


@query("op6_lm_score")
def op6_lm_score(spark, sf_dir):
    return lbl_model.score_texts(read(spark, sf_dir, "documents"))


@query("op12_simhash")
def op12_simhash(spark, sf_dir):
    """Fingerprint of every document and the near-duplicate component it is in."""
    return simhash_trie.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op13_whiten")
def op13_whiten(spark, sf_dir):
    """Every usable embedding on 16 whitened principal components."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


@query("op11_token_alignment")
def op11_token_alignment(spark, sf_dir):
    """How two public tokenisers cut every document, and how common the linked ids are."""
    return token_alignment.align(read(spark, sf_dir, "documents").select("doc_id", "text"))
