"""The registered queries: each applies its operator to the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.llm import bpe, centroids, codes, counts, decontaminate, jaccard, langid, packing, pii, quality, substrings, warc, whitening
from driftline.llm.ship import ship
from driftline.session import working_path

END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digest(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    return quality.judge(table(spark, sf_dir, "documents"), trusted)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    predicted = langid.predict(docs, langid.learn(docs), keep=["doc_id"])
    return predicted.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = working_path(spark, "archives")
    files = warc.write_index(warc.write_archives(pages, folder), folder)
    records = warc.read_records(warc.locate(warc.page_keys(pages), folder, files), folder)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), length=3, percent=90)


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = substrings.dedup(table(spark, sf_dir, "documents"), window=35)
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return counts.attribute(table(spark, sf_dir, "documents"), *paths)


def op9_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    folder = working_path(spark, "codes")
    files = codes.write_codes(table(spark, sf_dir, "documents"), folder, *paths, end_id=END_ID)
    return codes.with_crc(codes.read_codes(spark, folder, files))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    if model is None:
        kinds = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], kinds)
    rows = whitening.whiten(vectors, model)
    explained = F.array(*[F.lit(share).cast("double") for share in model.explained])
    each = F.posexplode(F.arrays_zip("whitened", explained.alias("explained")))
    return rows.select("vec_id", F.expr("try_cast(deviation AS bigint)").alias("deviation"), each.alias("place", "at")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "at.whitened",
        "at.explained",
        F.lit(whitening.identity_error(vectors, model)).cast("double").alias("identity_error"),
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, found = centroids.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64)
    inertia = F.coalesce(F.sum("cluster_inertia").over(Window.partitionBy()), F.lit(0)).alias("inertia")
    named = found.select("cluster", "cluster_inertia", inertia, F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))
    # A row per centroid.
    return placed.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    made = packing.pieces(table(spark, sf_dir, "documents"), *paths, end_id=END_ID)
    return packing.pack(made).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_pii": op2_pii,
    "op3_decontaminate": op3_decontaminate,
    "op4_langid": op4_langid,
    "op5_warc": op5_warc,
    "op6_jaccard": op6_jaccard,
    "op7_substrings": op7_substrings,
    "op8_token_counts": op8_token_counts,
    "op9_codes": op9_codes,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_centroids": op12_centroids,
    "op13_packing": op13_packing,
}
