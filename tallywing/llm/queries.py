"""The driver queries of the operators: each applies one to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywing.llm import collocations, fingerprints, html_text, language, mixing, neighbours, packing, quality, secrets, sentence_pieces, sql, substrings, weighted_minhash, whitening

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan(table(spark, sf, "documents")).withColumnRenamed("key", "doc_id")


def op2_pack(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf, "documents"))


def op4_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, sf, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(table(spark, sf, "pages"))


def op6_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    out = language.predict(docs, language.fit(docs.filter(~language.held_out("doc_id"))))
    return out.withColumn("held_out", language.held_out("doc_id"))


def op7_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf, "documents"))
    with_words = F.filter("draws", lambda d: d["words"] > 0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", with_words["shard"].alias("shards"))


def op8_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = quality.scores(docs, quality.learnt_from(docs, table(spark, sf, "labels")))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", predicted)


def op9_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return weighted_minhash.near_duplicates(table(spark, sf, "documents"))


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(table(spark, sf, "embeddings"))


def op13_sentence_pieces(spark: SparkSession, sf: str) -> DataFrame:
    out = sentence_pieces.encode_decode(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    ids = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256")
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), ids, F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Query] = {q.__name__: q for q in [op1_secret_scan, op2_pack, op3_fingerprints, op4_substring_dedup, op5_html_text, op6_language_id, op7_mix_sources, op8_quality, op9_nearest_neighbours, op10_minhash_near_dedup, op11_collocations, op12_whitening, op13_sentence_pieces]}

#: SQL for DuckDB where SQL can express the result.
ORACLE: dict[str, str] = {"op1_secret_scan": sql.secret_scan(), "op4_substring_dedup": sql.SUBSTRING_DEDUP, "op11_collocations": sql.COLLOCATIONS}
