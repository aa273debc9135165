"""The corpus pipeline: quality rules, line dedup, near-dedup, PII, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
has kept. ``run`` writes each stage's rows and reads them again, so a lost
executor costs at most the stage under way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barograph.llm import linededup, packing, pii, quality, simhash
from barograph.llm.queries import BYTE_BPE, QUERY_KEY
from barograph.llm.tables import ship_code, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that base rules or boosted trees reject go."""
    ship_code(spark)
    return quality.kept_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of alike lines one stays; documents stay, even if no line of them does."""
    ship_code(spark)
    return linededup.deduplicated(docs, least=1)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship_code(spark)
    return simhash.one_of_each(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to pseudonyms of its format."""
    ship_code(spark)
    return pii.pseudonymised(docs, QUERY_KEY)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 1024 tokens."""
    ship_code(spark)
    return packing.packed(docs, BYTE_BPE, 2, chunks_kept=CHUNKS_KEPT)


#: The stages share Python workers, so the tokenizer's memory there is small.
CHUNKS_KEPT = 250_000

STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("pii", pseudonyms),
    ("best_fit_packing", best_fit_packing),
]

#: The stages rest on trained trees, 64-bit hashes and tokenizers, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
