"""The queries of this subpackage and the SQL that says the same, where SQL can."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.functions.staging import run_dir

from . import code_lloyd, divergence, html_extract, jaccard_forest, mixing, piece_scan, quality_model, quality_rules, quotes, sharding, token_store, topk, url_filter
from .common import table


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix_sources(docs)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "pieces")


def op2_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    out = sharding.shard_rows(rows, 16, ["doc_id"], seed=2)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extract.extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", "n_chars")


#: (host, path, verdict)
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"), RULES, rounds=None)


#: The public SentencePiece model that the queries use; the operator takes any model's content.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def piece_model(path: str = PIECE_MODEL) -> bytes:
    return Path(path).read_bytes()


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piece_model()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = piece_scan.decode(piece_scan.encode(docs, model), model, text="decoded")
    same = F.col("decoded").eqNullSafe(F.replace("text", F.lit("\u2581"), F.lit(" ")))
    return both.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality_model.classify(docs, labels)


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality_rules.judge_documents(docs, labels)


def op9_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_forest.near_copies(docs).select("doc_id", "copy_id", "class_id", "n_links")


#: The public tokenizer of the token store; the operator takes any file of the tokenizers library.
TOKENIZER = "byte_bpe_50k.json"


def op11_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs, path = table(spark, sf_dir, "documents").select("doc_id", "text"), f"{run_dir(spark)}/token-store-{uuid.uuid4().hex}"
    token_store.write_store(docs, path, public_tokenizers.path(TOKENIZER))
    ids = token_store.fetch(spark, path, docs.select("doc_id"), unkeyed=True, binary=True)
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = code_lloyd.compress(table(spark, sf_dir, "embeddings"), keep=("label",))
    coded = code_lloyd.with_group_errors(coded).withColumn("codebooks_sha256", F.lit(books.sha256()))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_mix": op1_mix,
    "op2_shard": op2_shard,
    "op3_extract": op3_extract,
    "op4_urls": op4_urls,
    "op5_pieces": op5_pieces,
    "op6_topk": op6_topk,
    "op7_quality": op7_quality,
    "op8_rules": op8_rules,
    "op9_quotes": op9_quotes,
    "op10_jaccard": op10_jaccard,
    "op11_ids": op11_ids,
    "op12_codes": op12_codes,
    "op13_divergence": op13_divergence,
}

ORACLES: dict[str, str] = {
    "op4_urls": url_filter.sql(RULES),
    "op6_topk": topk.sql(),
    "op9_quotes": quotes.sql(),
    "op12_codes": code_lloyd.sql(),
    "op13_divergence": divergence.sql(),
}
