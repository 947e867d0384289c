"""The corpus pipeline: language ID, exact dedup, n-gram Jaccard join, substring dedup, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept; all but the last return the
columns of ``documents``.

Defined cases, for all stages: an empty table gives no rows; further columns pass through whatever their names (but for
the last stage, which returns pieces); texts of any length count whole. Null texts and texts without letters end in the first stage; the later
ones, taken alone, treat a null text as their docstrings tell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelforge.llm import exact_dedup, jaccard_join, language_id, packing, paragraph_dedup
from parcelforge.llm.queries import tokenizer_file
from parcelforge.llm.scratch import materialise


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labels teach. Texts without letters, of jumbled letters and in other languages go
    (``lang_known``). Null and empty texts go; repeated rows stay; no labels, no documents; the columns stay as they are."""
    own = {n: f"c{k}" for k, n in enumerate(docs.columns)}
    found = language_id.predict(docs.toDF(*own.values()), language_id.fit(docs), text_col=own["text"]).where("lang_known")
    return found.select(*(F.col(c).alias(n) for n, c in own.items()))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the document with the largest id. A null text counts as empty; rows without an id
    lose to any with one; of repeated rows one stays."""
    index = exact_dedup.DigestIndex(spark)
    kept = exact_dedup.keep_first_copies(docs, index)
    index.drop()  # a user keeps it for the next batch; the result doesn't read it
    return kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a shingle Jaccard of 0.8 or more, directly or through others, the one of the least id. Null
    and empty texts and rows without an id stay; repeated rows of one id stay or go together."""
    return jaccard_join.keep_one_of_each(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words or more that another document, or an earlier place of the same one,
    keeps. Documents of which nothing is left go; null and empty texts and rows without an id stay as they are."""
    cut = paragraph_dedup.without_passages(docs, paragraph_dedup.repeated_passages(docs))
    return cut.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else cut


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048 tokens. A null text is the end id alone; repeated rows are packed each."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]
#: The language model and the packing can't be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
