"""A corpus pipeline of the training-data operators.

Quality rules, near-duplicates, pseudonyms, mixing and tokenising, in this
order. Each stage works on all that the one before kept; all but the last
return the columns of documents, with the table's own values: rows travel
beside what a stage computes, so columns that bear a result's name stay as they
were.

Edge cases: rows without text or words fail the quality rules. Equal texts
under several ids leave the one of least id; rows that repeat an id are
documents of their own, judged alike, and all of them stay where the id stays.
A null id resembles nothing, and is mixed as an id like any other. Null sources
are a source. Ties between near-duplicates go to the least id. Very long texts
are handled whole. An empty table gives an empty result with the same columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from folioflow.llm import bpe, mixing, pii, quality, simhash
from folioflow.llm.common import cut, table
from folioflow.llm.queries import DEMO_KEY


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    hidden = {c: f"__{i}" for i, c in enumerate(docs.columns)}  # names that no result has
    judged = quality.judge(docs.toDF(*hidden.values()), public_tokenizers.path("piece_bpe_32k.model"), hidden["text"], tuple(hidden.values()), hidden.get("lang", ""))
    return judged.where("kept").select(*[F.col(new).alias(c) for c, new in hidden.items()])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data under pseudonyms; a production run names its key in the session."""
    hidden = pii.pseudonymise(docs.select(F.struct("*").alias("__row"), "text"), key=spark.conf.get(pii.KEY_SETTING, DEMO_KEY))
    return hidden.select(*[F.col("text") if c == "text" else F.col("__row")[c].alias(c) for c in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.repeated(docs)


def tokenise_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids, and whether they decode to its text.

    Byte offsets of ids are left out here: they are the running sum of the ids'
    lengths, which decoding makes anew."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode_texts(docs.select("doc_id", "source", "text"), vocabulary, places=False, check=True)
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("PII", pii_stage),
    ("mixing", mixing_stage),
    ("byte-level BPE", tokenise_stage),
]

#: Vocabularies, sets of hashes and permutations have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs, name.replace(" ", "-").lower())
    return docs
