"""Registered queries of the corpus operators: name -> fn(spark, sf_dir)."""

from __future__ import annotations

from payrisk.llm import chat, merkle, mixing, trie
from payrisk.llm.common import table
from payrisk.llm.hnsw import neighbours_query
from payrisk.llm.langid import language_query
from payrisk.llm.licenses import license_query
from payrisk.llm.minhash import dedup_query
from payrisk.llm.packing import packing_query
from payrisk.llm.quality import quality_query
from payrisk.llm.rules import rules_query
from payrisk.llm.toxicity import toxicity_query
from payrisk.llm.vecdup import near_vectors


def op1_packing(spark, sf_dir):
    """All documents packed into sequences of 2048 tokens: one row per piece."""
    return packing_query(table(spark, sf_dir, "documents"))


def op2_chat(spark, sf_dir):
    """All conversations as preference pairs: prompt once, two masked completions."""
    return chat.chat_query(table(spark, sf_dir, "conversations"))


def op3_vectors(spark, sf_dir):
    """Links and components of all embeddings with equal labels and cosine 0.93 or more."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op4_quality(spark, sf_dir):
    """Quality score of every document; learnt outside the held-out fold."""
    return quality_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language(spark, sf_dir):
    """Language of every document; learnt outside the held-out fold."""
    return language_query(table(spark, sf_dir, "documents"))


def op6_licenses(spark, sf_dir):
    """Licence phrases and notices in every document."""
    return license_query(table(spark, sf_dir, "documents"))


def op7_rules(spark, sf_dir):
    """Base counts and the learned decision list over every document."""
    return rules_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark, sf_dir):
    """Words of every document that the mix to target weights takes."""
    return mixing.mixing_query(table(spark, sf_dir, "documents"))


def op9_minhash(spark, sf_dir):
    """Near-duplicate group of every document."""
    return dedup_query(table(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir):
    """Toxicity of every document; learnt outside the held-out fold."""
    return toxicity_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_trie(spark, sf_dir):
    """Every prefix of the rebuilt conversations, with its members, children, leaves and saved bytes."""
    return trie.trie_query(table(spark, sf_dir, "conversations"))


def op12_neighbours(spark, sf_dir):
    """The 20 nearest rows, by inner product, of every 20th embedding."""
    return neighbours_query(table(spark, sf_dir, "embeddings"))


def op13_merkle(spark, sf_dir):
    """Leaf, subroot, root and proof of every document; one in five is tampered with and must be found out."""
    return merkle.manifest_query(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_chat": op2_chat,
    "op3_vectors": op3_vectors,
    "op4_quality": op4_quality,
    "op5_language": op5_language,
    "op6_licenses": op6_licenses,
    "op7_rules": op7_rules,
    "op8_mixing": op8_mixing,
    "op9_minhash": op9_minhash,
    "op10_toxicity": op10_toxicity,
    "op11_trie": op11_trie,
    "op12_neighbours": op12_neighbours,
    "op13_merkle": op13_merkle,
}
SQL: dict[str, str] = {"op2_chat": chat.SQL, "op8_mixing": mixing.SQL, "op11_trie": trie.SQL, "op13_merkle": merkle.SQL}
