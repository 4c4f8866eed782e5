"""Registered queries of this subpackage: op<N>_<name>, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.centroids import centroid_clusters
from tessera.llm.collocations import collocations
from tessera.llm.common import documents
from tessera.llm.decontaminate import benchmark_hits, contamination
from tessera.llm.licenses import license_scan
from tessera.llm.line_dedup import dedup_lines
from tessera.llm.near_duplicates import near_duplicates
from tessera.llm.order_minhash import fingerprints
from tessera.llm.oracle import ORACLE as ORACLE
from tessera.llm.packing import pack_documents
from tessera.llm.pii import personal_data
from tessera.llm.set_join import ngram_join
from tessera.llm.sharding import interleaved_shards
from tessera.llm.token_counts import sentence_pieces, token_counts
from tessera.llm.toxicity import toxicity
from tessera.session import configure

QueryFn = Callable[[SparkSession, str], DataFrame]


def public_vocabulary(name: str) -> Callable[[], str]:
    """Finds a public vocabulary file where the task runs."""
    def path() -> str:
        import public_tokenizers
        return public_tokenizers.path(name)
    return path


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(configure(spark), sf_dir)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, benchmark_hits(docs, benchmark))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(configure(spark), sf_dir), k=3, percent=85)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(configure(spark), sf_dir))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(configure(spark), sf_dir).select("doc_id", "text")
    out = dedup_lines(docs, counts=("n_lines", "n_dropped"))
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").alias("n_chars_kept"),
                      F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(configure(spark), sf_dir),
                    spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(configure(spark), sf_dir))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(configure(spark), sf_dir),
                          public_vocabulary("word_bpe_49k.json"))


def op8_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleaved_shards(documents(configure(spark), sf_dir))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(configure(spark), sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_vocabulary("piece_bpe_32k.model")
    return token_counts(documents(configure(spark), sf_dir), lambda: sentence_pieces(vocabulary()))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(configure(spark), sf_dir))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(documents(configure(spark), sf_dir))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(configure(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, QueryFn] = {
    "op1_decontamination": op1_decontamination,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_license_scan": op3_license_scan,
    "op4_line_dedup": op4_line_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_order_minhash": op6_order_minhash,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_interleaved_shards": op8_interleaved_shards,
    "op9_personal_data": op9_personal_data,
    "op10_token_counts": op10_token_counts,
    "op11_collocations": op11_collocations,
    "op12_ngram_join": op12_ngram_join,
    "op13_centroid_clusters": op13_centroid_clusters,
}
