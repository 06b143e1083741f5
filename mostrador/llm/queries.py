"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from mostrador.llm import (
    language, licenses, mixing, neardup, neighbours, packing, phrases, pii, quality, rulefit, runs, secrets, sharding,
)
from mostrador.llm.common import WORD, bound
from mostrador.llm.oracles import ORACLES
from mostrador.llm.spans import count_of, digest


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_minhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    base = F.filter("spans", lambda s: s["rank"] < len(secrets.BASE_RULES))
    return secrets.scan(docs).select(
        "doc_id",
        *[count_of(F.col("spans"), r.kind).alias(f"n_{r.kind}") for r in secrets.BASE_RULES],
        F.sha2(digest(base), 256).alias("base_sha256"),
        digest(F.col("spans")).alias("spans"),
    )


def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    taken = (F.col("size") * F.col("turns")).alias("taken")
    return mixing.mix(docs, keep=["doc_id"]).select("doc_id", "size", "source_size", "target", taken)


def op4_graph_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    asked = vectors.where(F.col("vec_id") % 100 == 0).withColumnRenamed("vec_id", "query_id")
    return neighbours.nearest_neighbours(vectors, asked)


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.judge(docs, table(spark, folder, "labels")).drop("text")


SHARDS = 24


def op6_shuffle_shards(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    order = [F.col(c) for c in docs.columns]
    return sharding.shard(docs, order, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return licenses.scan(docs).drop("text", "found")


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return language.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    base = F.filter("spans", lambda s: s["rank"] < len(pii.BASE_KINDS))
    return pii.scan(docs, keep=["doc_id"]).select(
        "doc_id",
        *[count_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(digest(base), 256).alias("base_sha256"),
        digest(F.col("spans")).alias("spans"),
    )


def op10_pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(docs)


def op11_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = rulefit.classify(docs, table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, from some word on, repeat the words from there with a period."""
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    grams = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))

    def repeated(words):
        n = F.size(words)
        a = F.floor(key / 10) % n
        p = 1 + F.floor((n - a) / (3 + F.floor(key / 10) % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, place(i))), " ")

    planted = bound(grams, lambda words: F.when(F.size(words) > 0, repeated(words)).otherwise(""))
    return docs.withColumn("text", F.when(key % 10 == 0, planted).otherwise(F.col("text")))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = runs.periodic_runs(with_planted_runs(docs))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    ranked = F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run")))
    longest = F.array_max(ranked)["run"]
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "runs", "collapsed", longest.alias("longest")).select(
        "doc_id",
        "n_runs",
        "longest.start",
        "longest.length",
        "longest.period",
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents").select("lang", "text"))


QUERIES = {
    "op1_minhash_neardup": op1_minhash_neardup,
    "op2_secret_scan": op2_secret_scan,
    "op3_mix_sources": op3_mix_sources,
    "op4_graph_neighbours": op4_graph_neighbours,
    "op5_quality_rules": op5_quality_rules,
    "op6_shuffle_shards": op6_shuffle_shards,
    "op7_license_scan": op7_license_scan,
    "op8_language_id": op8_language_id,
    "op9_personal_data": op9_personal_data,
    "op10_pack_sequences": op10_pack_sequences,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_collocations": op13_collocations,
    "pipeline": corpus_pipeline.run,
}

__all__ = ["ORACLES", "QUERIES"]
