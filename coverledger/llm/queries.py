"""Registered queries of the training-data operators, with checking SQL where SQL can say it."""

from __future__ import annotations

import functools
import io
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import coverledger
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverledger.llm import (
    alignment,
    bpe,
    embeddings,
    exact,
    html,
    language,
    mixing,
    packing,
    scoring,
    search,
    sharding,
    simhash,
    substrings,
)
from coverledger.llm.common import table, work_folder

SHARDS = 24


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def _ship(application: str) -> None:
    """Give the workers this package, wherever the driver found it; once per application."""
    spark = SparkSession.getActiveSession()
    root, held = Path(coverledger.__file__).parent, io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, str(file.relative_to(root.parent)))
    path = f"{work_folder(spark)}/package-{uuid.uuid4().hex}.zip"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    out = store.create(place)
    out.write(bytearray(held.getvalue()))
    out.close()
    store.deleteOnExit(place)
    spark.sparkContext.addPyFile(path)


def _shipped(query: Callable) -> Callable:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _ship(spark.sparkContext.applicationId)
        return query(spark, sf_dir)

    return run


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.select("doc_id", digits.alias("fingerprint"), "component_id")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.col("kept_text"), 256)
    return rows.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.size("_draws") * F.col("_size")).cast("long").alias("taken"),
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_rows(table(spark, sf_dir, "documents"), SHARDS)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact.exact_dedup(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.filter(language.learned_from("doc_id")))
    rows = language.identify(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(~language.learned_from("doc_id"), F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file())


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    rows = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), ranks), ranks)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return search.search(documents, items)


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    digest = functools.partial(F.sha2, numBits=256)
    rows = alignment.align(table(spark, sf_dir, "documents"), *files, groups_as=digest)
    return rows.withColumnRenamed("groups", "groups_sha256")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: _shipped(f)
    for f in (
        op1_simhash_near_dedup,
        op2_lm_scoring,
        op3_substring_dedup,
        op4_source_mixing,
        op5_sharding,
        op6_embedding_near_dedup,
        op7_exact_dedup,
        op8_language_id,
        op9_html_extraction,
        op10_best_fit_packing,
        op11_byte_bpe,
        op12_ranked_search,
        op13_cross_tokenizer_alignment,
        pipeline,
    )
}
