"""Registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise.llm import language, licenses, mixing, neardup, quality, runs, secrets, sentencepiece, simhash, sketches, toxicity, warc, whitening
from sitewise.llm.common import held_out, read
from sitewise.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return register


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.digest(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


@query("op2_mixing", mixing.oracle())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = read(spark, sf_dir, "documents").select("doc_id", "source", mixing.words().alias("size"))
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", "taken")


@query("op3_simhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def _judged(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


@query("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    known = read(spark, sf_dir, "labels").where(~held_out("doc_id", 5, 0))
    return _judged(quality.score(docs, quality.train(docs, known, "quality")), 0.3)


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    known = read(spark, sf_dir, "labels").where(~held_out("doc_id", 5, 0))
    return _judged(toxicity.scores(docs, known, "toxic"), 0.5)


@query("op5_licenses", licenses.oracle())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(read(spark, sf_dir, "documents"))


@query("op7_secrets")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan(docs, secrets.train(docs))


@query("op8_language")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    apart = held_out("doc_id", 3, 1)
    model = language.train(docs.where(~apart))
    rows = docs.select("doc_id", "text", apart.alias("held_out"))
    return language.predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


@query("op9_embedding_neardup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "embeddings"))


@query("op10_fingerprints")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(read(spark, sf_dir, "documents"))


@query("op11_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.with_repeats(read(spark, sf_dir, "documents")))


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.table(read(spark, sf_dir, "embeddings"))


@query("op13_warc", warc.oracle())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_warc(warc.deduplicated(read(spark, sf_dir, "pages")), archives)
    return warc.page_records(spark, archives)
