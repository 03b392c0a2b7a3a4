"""From documents to tokens: language, near-duplicates, personal data, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read back as the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstar.llm import bpe, language, mixing, pii, simhash
from cellstar.llm.queries import tokenizer_path
from cellstar.llm.shared import staged

#: Least probability of the predicted language of a document that stays.
LEAST_SCORE = 0.5


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose language is predicted with some confidence."""
    judged = language.identify(docs, prefix="_")
    known = (F.col("_lang_pred") != language.UNKNOWN) & (F.col("_score") >= LEAST_SCORE)
    return judged.where(known).select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints."""
    return simhash.one_of_each(docs, shingle=3, radius=2)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data replaced by its kind and the length brought up to date."""
    clean = pii.redact(docs, pii.train(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.coalesce(F.char_length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per draw of a whole document, laid out by shard."""
    drawn = mixing.shard_rows(mixing.mix(docs, cut=False, name="_mixed"), prefix="_", name="_mixed")
    return drawn.select(*[F.col(f"`{c}`") for c in docs.columns])


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every row, with digests of them and of the decoded text."""
    return bpe.encode(docs, tokenizer_path()).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_known_languages),
    ("near_copies", keep_one_of_near_copies),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]
#: SQL can express neither the classifier, the fingerprints nor the merges; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = staged(docs)
    return docs


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
