"""From raw documents to token ids: a quality filter, exact and near
de-duplication, mixing by source, and SentencePiece ids.

``STAGES`` lists the steps. Each gets the session, the documents its
predecessor kept and the folder of the tables, and returns a DataFrame that is
written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm import exact_dedup, mixing, quality, sentencepiece_bpe, simhash
from tallgrass.llm.common import fresh, table, written
from tallgrass.session import release

#: The model's name among the public tokenizers.
MODEL = "piece_bpe_32k.model"


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model learned from all labelled documents accepts. Null
    and empty texts are scored like any other, repeated rows alike; without
    labels every document stays. All columns are handed through."""
    (score,) = fresh(docs, "score")
    model = quality.train(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return quality.with_score(docs, model, out=score).filter(F.col(score) >= quality.CUT).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest id
    (null ids last, of repeated rows any one). Null and empty texts are equal."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the
    smallest id (null ids last). Texts without words are one group."""
    return simhash.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it: not at all, once
    or twice. Null sources are one source; texts without words have size 0."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, the piece ids of each text and the text that they
    decode to. Null and empty texts have no ids and decode to an empty text."""
    import public_tokenizers

    out = sentencepiece_bpe.encode_decode(docs.select("doc_id", "source", "text"), public_tokenizers.path(MODEL), decoded="decoded")
    return out.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("quality classifier", quality_filter), ("exact dedup", exact), ("SimHash near-dedup", near),
          ("source mixing", mixed), ("SentencePiece", encoded)]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written and read
    again. An empty table gives an empty result."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            made, docs = docs, written(docs, f"stage-{k}")
            release(made, before)  # what the stage read and what it left behind
    return docs
