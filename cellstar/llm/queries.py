"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstar.llm import bpe, language, manifest, mixing, near_vectors, pages, pii, simhash, spelling, substrings, token_files, top_products, urls


#: Default place of the public tokenizer file; a parameter of the operator.
WORD_BPE = "word_bpe_49k.json"


def tokenizer_path(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select(
        F.col("id").alias("doc_id"), simhash.hex_print(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encode(_table(spark, sf_dir, "documents"), tokenizer_path(), keep_ids=False, kept=400_000)
    return rows.withColumnRenamed("id", "doc_id")


def op4_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(_table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    columns = [F.col(f"mixed.{c}") for c in ("size", "source_size", "target")]
    taken = F.aggregate("mixed.draws", F.lit(0).cast("long"), lambda n, d: n + d["words"])
    return mixed.select("doc_id", *columns, taken.alias("taken"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    spans = pii.find(docs, pii.train(docs))

    def listed(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])
    return spans.select(
        F.col("id").alias("doc_id"), *[_count(base, kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.9)
    return found.withColumnRenamed("id", "vec_id").withColumnRenamed("component", "component_id")


def op10_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products.top_k(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = _table(spark, sf_dir, "documents").select(*fields)
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = manifest.leaf_digest([lower if f == "text" else F.col(f) for f in fields])
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    proofs = manifest.manifest(docs, fields, tampered=F.when(hit, changed))
    again = manifest.folded(F.col("presented"), F.col("path"))
    return proofs.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", manifest.proof_digest(F.col("path")).alias("proof_sha256"),
        again.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    files = token_files.write(docs, tokenizer_path(), end_id=1)
    found = token_files.read(files, docs.schema["doc_id"].dataType.simpleString(), keep_ids=False)
    return found.withColumnRenamed("id", "doc_id")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(spelling.words(_table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_substrings": op2_substrings,
    "op3_bpe": op3_bpe,
    "op4_pages": op4_pages,
    "op5_mixing": op5_mixing,
    "op6_pii": op6_pii,
    "op7_near_vectors": op7_near_vectors,
    "op8_urls": op8_urls,
    "op9_language": op9_language,
    "op10_top_products": op10_top_products,
    "op11_manifest": op11_manifest,
    "op12_token_files": op12_token_files,
    "op13_spelling": op13_spelling,
}
ORACLE: dict[str, str] = {
    "op5_mixing": mixing.ORACLE,
    "op8_urls": urls.oracle(),
    "op11_manifest": manifest.oracle(),
    "op13_spelling": spelling.oracle(),
}
