"""The registered queries of this subpackage, with the SQL stating their results where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import (
    alignment,
    dac,
    hilbert,
    lines,
    mixing,
    ngram_join,
    phrases,
    pieces,
    sql,
    templates,
    topk,
    toxicity,
    urls,
    warc,
)
from siltstone.session import fresh_path, written

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
TOXIC_FROM = 0.7
SHARDS = 24
MIX_TARGETS = {"source": 0.7, "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}, "topic": 0.7}
MIX_BUDGET = 0.5
MIX_SEED = 17
TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_TOKENIZER = "byte_bpe_50k.json"
END_ID = 1


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_url_filter", sql.URL_FILTER)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.filter_urls(table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict", "reason")


def held_out() -> object:
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    return toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", training=~held_out())


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.scored_documents(docs, toxicity_model(spark, docs, sf_dir), TOXIC_FROM)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query("op3_template_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_ngram_jaccard_join", sql.NGRAM_JACCARD)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.ngram_jaccard_join(table(spark, sf_dir, "documents"), words=3, num=90, den=100)
    return joined.select("doc_id", "n_shingles", "component_id", "n_links")


def measured(docs: DataFrame) -> DataFrame:
    return docs.withColumns(
        {"mix_tokens": mixing.token_count(F.col("text")), "topic": mixing.topic_of(F.col("text"))}
    )


def mixed(docs: DataFrame) -> DataFrame:
    return mixing.mix(docs, MIX_TARGETS, MIX_BUDGET, seed=MIX_SEED)


@query("op5_mix_to_targets")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = measured(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"))
    # Narrow rows, written: texts are measured once, not for the cells and again for the draw.
    docs = written(docs.drop("text"), "mixing-measured")
    return mixed(docs).select(
        "doc_id", "source", "lang", "topic", "mix_tokens", "mix_weight", "mix_probability", "mix_kept", "mix_gap"
    )


@query("op6_warc_archive", sql.WARC)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), folder)
    records = warc.read_warc(spark, folder, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_hilbert_sharding")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard_documents(table(spark, sf_dir, "documents"), SHARDS)


@query("op8_exact_top_k", sql.TOP_K)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.grid_vector(F.col("embedding")).alias("vector"))
    return topk.top_products(vectors, F.col("vec_id") % 20 == 0, 20)


@query("op9_line_dedup", sql.LINE_DEDUP)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest_kept(lines.drop_repeated_lines(table(spark, sf_dir, "documents"), min_docs=10, least=1))


@query("op10_token_files")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "tokens")
    dac.write_tokens(table(spark, sf_dir, "documents"), folder, tokenizer_path(), END_ID)
    return dac.digest_tokens(spark, folder)


@query("op11_piece_spans")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest_documents(table(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL))


@query("op12_phrase_graph", sql.PHRASES)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(table(spark, sf_dir, "documents"), least=30, limit=2_000)


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align_corpus(docs, tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_MODEL))[0]
