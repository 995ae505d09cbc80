"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table

#: Key of the registered queries where the session names none: they run on made-up tables, and it is no secret.
DEMO_KEY = "made-up tables only"
Query = Callable[[SparkSession, str], DataFrame]


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every embedding whose id is divisible by 20."""
    from pyspark.sql import functions as F

    from .ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids under the 50k byte-level vocabulary, as digests, and what they decode to."""
    import public_tokenizers

    from .bpe import encode_texts

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), digests=True)


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps without the 100-byte strings that start earlier."""
    from .suffixes import removed

    return removed(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text under pseudonyms, and how many of each kind it had."""
    from .pii import KEY_SETTING, pseudonymise

    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key=spark.conf.get(KEY_SETTING, DEMO_KEY))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a seeded mix takes of every document."""
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts, fertility and verdict."""
    import public_tokenizers

    from .quality import judge

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=("doc_id",))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps without the 13-word windows of smaller documents."""
    from .substrings import removed

    return removed(table(spark, sf_dir, "documents"))


def op9_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score, learned from the labelled rows that aren't held out."""
    from pyspark.sql import functions as F

    from .classifier import labelled_sample, score, train

    held_out = lambda key: F.crc32(key.cast("string").cast("binary")) % 3 == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights, bias = train(*labelled_sample(docs, table(spark, sf_dir, "labels"), held_out))
    return score(docs, weights, bias, keep=("doc_id",)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets: counts of the fixed forms, their digest, and all spans."""
    from pyspark.sql import functions as F

    from .secrets import scan

    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=("doc_id",))

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")], F.sha2(line(base), 256).alias("base_sha256"), line(F.col("secrets")).alias("spans"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {"op1_ann": op1_ann, "op2_bpe": op2_bpe, "op3_suffixes": op3_suffixes, "op4_pii": op4_pii, "op5_mixing": op5_mixing, "op6_quality": op6_quality, "op7_simhash": op7_simhash, "op8_substrings": op8_substrings, "op9_classifier": op9_classifier, "op10_secrets": op10_secrets, "pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    from . import mixing, substrings, suffixes

    return {"op3_suffixes": suffixes.SQL, "op5_mixing": mixing.sql(), "op8_substrings": substrings.SQL}
