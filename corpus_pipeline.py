"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``; ``n_chars`` follows the text where a stage
changes it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableload.llm.bpe import encode_documents
from tableload.llm.common import save, table
from tableload.llm.jaccard_join import keep_one_each
from tableload.llm.line_dedup import dedup_lines
from tableload.llm.pfair_mix import mix_documents, with_slots
from tableload.llm.quality_mcd import keep_quality

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the outlier test reject go."""
    return keep_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in three documents or more stay in the last one only."""
    columns = docs.columns
    left = dedup_lines(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*columns) if "n_chars" in columns else left


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays."""
    return keep_one_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of their slots."""
    return mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, slot, place, n_tokens, ids and the digests of ids and decoded bytes.

    Rows read again from several files come in any order, so the mix is carried
    as columns: slot and place depend on doc_ids and sources alone and are those
    that the mix stage ordered by.
    """
    placed = with_slots(docs.select("doc_id", "lang", "source", "text")).withColumnsRenamed({"__slot": "slot", "__place": "place"})
    return encode_documents(placed, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=("doc_id", "lang", "source", "slot", "place"))


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Near duplicates and outliers are not expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
