"""From documents to packed sequences: five stages, each written and read again.

Every stage takes what the one before kept and returns the columns of documents; the
last returns the pieces of the packed sequences. Null or letterless texts go in the
first stage, texts that line removal empties are copies of one another in the third.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, line_dedup, packing, simhash
from tidemark.llm.queries import remainder
from tidemark.llm.shared import fresh, load, ready, settle

#: A text's own language must hold at least this share of its words.
LEAST_SHARE = 0.3
TOKENIZER = "word_bpe_49k.json"
END = 1


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters and those in which no language has a clear share.

    The model learns from the languages that ``docs`` states, without the part that
    ``op7_language`` holds out. If it states none, only texts without letters go.
    """
    ready(spark)
    model = language.learn(docs, where=remainder(docs, 4) != 2)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = fresh(docs, "found")
    labelled = docs.withColumn(found, language.identified(docs["text"], model, spark))
    known = F.col(found)["lang_pred"] != language.NONE
    return labelled.where(known & (F.col(found)["score"] >= LEAST_SHARE)).drop(found)


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove later repeated runs of lines from the texts."""
    return line_dedup.deduplicated(docs)


def deduplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return simhash.deduplicated(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which at least a twentieth lies in benchmark items."""
    return decontaminate.clean_documents(docs, load(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents' tokens into sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), END)


STAGES = [
    ("language", identify_language),
    ("line dedup", deduplicate_lines),
    ("near-duplicates", deduplicate_documents),
    ("decontamination", remove_contaminated),
    ("packing", pack_sequences),
]

#: Models and tokenizers are beyond SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    ready(spark)
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
