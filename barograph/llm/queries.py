"""Registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barograph.llm import (
    alignment,
    bpetrie,
    cubemix,
    hashtree,
    licenses,
    linededup,
    packing,
    pii,
    quality,
    simhash,
    tokenfile,
    veccodes,
    vptree,
)
from barograph.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]

#: The queries' own key; a job passes one that is kept secret.
QUERY_KEY = b"key of the registered queries"
#: Prunes where the gap exceeds a quarter of the best distance; recall is in the README.
RELAXED = 4.0
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and boosted trees over all documents, fitted on a sample of the labels."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model)


def op2_gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all documents, links at 4 differing bits or fewer."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, each closed by id 2, in sequences of at most 1024 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), BYTE_BPE, 2)


def op4_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with format-preserving pseudonyms, and how many values each had."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs, QUERY_KEY, count="replaced")


def op5_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all, by largest inner product."""
    return vptree.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20, factor=RELAXED)


def op6_minhash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated and near-equal lines, and how many each lost."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.deduplicated(docs, count="removed", least=1)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, closed by id 0, written to token files and read back."""
    return tokenfile.token_file_roundtrip(table(spark, sf_dir, "documents"), BYTE_BPE, 0)


def op8_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of 2 regions of 2 racks; grown by a seventeenth."""
    tree = hashtree.even_tree(16)
    return hashtree.sharded(table(spark, sf_dir, "documents"), tree, hashtree.with_shard(tree))


def op9_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by the word trie and decoded again."""
    return bpetrie.encoded(table(spark, sf_dir, "documents"), BYTE_BPE)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, and lines of them, that are a known licence or notice."""
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op11_pointer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens by two tokenizers, in groups, with corpus-wide link counts."""
    return alignment.token_alignment(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


def op12_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, sources mixed by weights 1, 2, 3, each document at most three times."""
    return cubemix.mixed(table(spark, sf_dir, "documents"))


def op13_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as 16 codes of 64 entries, found by an access tree over the entries."""
    return veccodes.vector_codes(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_boosted_quality": op1_boosted_quality,
    "op2_gray_simhash": op2_gray_simhash,
    "op3_vector_packing": op3_vector_packing,
    "op4_feistel_pseudonyms": op4_feistel_pseudonyms,
    "op5_vantage_trees": op5_vantage_trees,
    "op6_minhash_lines": op6_minhash_lines,
    "op7_token_files": op7_token_files,
    "op8_hash_tree": op8_hash_tree,
    "op9_trie_bpe": op9_trie_bpe,
    "op10_license_scan": op10_license_scan,
    "op11_pointer_alignment": op11_pointer_alignment,
    "op12_cube_mixing": op12_cube_mixing,
    "op13_gnat_codes": op13_gnat_codes,
}

ORACLES: dict[str, str] = {
    "op10_license_scan": licenses.oracle(),
}
