"""A corpus from documents to token ids: five operators of ``taxaflow.llm``, one after the other.

Rules and the classifier drop what they reject, one document of each class of near copies stays, sources are mixed to
their target weights (a document is repeated, cut or left out as its source's share says), and the mix is encoded.

Every stage takes any table with the columns of documents: null keys, sources and languages are values like others, long
texts are read whole, repeated rows are documents of their own until near copies go, an empty table gives an empty one,
and of columns whose names clash the ones spelled as in documents count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.llm import jaccard_forest, mixing, piece_scan, quality_model, quality_rules
from taxaflow.llm.common import materialize, table
from taxaflow.llm.queries import piece_model


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that pass the base rules and the isolation forest; null and empty texts fail the base rules."""
    return quality_rules.keep_documents(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the weakly supervised classifier accepts; null and empty texts have the bias alone as score."""
    return quality_model.keep_documents(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies, the one of the least key; null and empty texts all stay."""
    return jaccard_forest.keep_documents(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: a row for each pass over a document, its text cut to the words taken. Null and
    empty texts have no words to take."""
    return mixing.cut_texts(mixing.mix_sources(docs))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents' token ids; a null text has null ids, an empty one none, and both n_tokens 0."""
    encoded = piece_scan.encode(docs.select("doc_id", "lang", "source", "text"), piece_model())
    return encoded.select("doc_id", "lang", "source", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding", sentencepiece_stage),
]

#: No stage but the base rules can be said in SQL: the forest, the classifier and the permutations can't.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
