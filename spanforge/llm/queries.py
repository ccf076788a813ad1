"""One query for each operator, over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm import common
from spanforge.llm.common import Shared, table

END_ID = 2


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanforge.llm import quality

    out = quality.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality", F.col("votes").cast("array<int>").alias("votes"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanforge.llm import licenses

    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanforge.llm import mixing

    taken, sources = mixing.mix_sources(table(spark, sf_dir, "documents"), F.array("source"))
    out = taken.withColumn("source", F.col("members")[0])
    out = out.join(F.broadcast(sources.withColumnRenamed("source", "of")), out.source.eqNullSafe(F.col("of")))  # mixing.MAX_PATTERNS bounds it
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanforge.llm import decontaminate

    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanforge.llm import substrings

    return substrings.repeated(table(spark, sf_dir, "documents"))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are labelled by the document that their URL numbers: block if it is of low quality or toxic."""
    from spanforge.llm import urls

    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    number = F.expr(r"try_cast(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]+)', 1) as bigint)")
    bad = labels.groupBy(F.col("doc_id").alias("number")).agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("block"))
    labelled = pages.select("url", number.alias("number")).where("number is not null").join(bad, "number").select("url", "block")
    return urls.judge(pages, labelled)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanforge.llm import toxicity

    return toxicity.grade_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanforge.llm import token_store

    shards = Shared(spark).write(token_store.encode_shards(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID))
    return token_store.read_documents(shards)


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanforge.llm import minhash

    out = minhash.near_duplicates(table(spark, sf_dir, "documents"), common.space_hashes, k=2, percent=80)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanforge.llm import language

    docs = table(spark, sf_dir, "documents")
    samples = language.sample(docs, F.col("doc_id").isNotNull() & ~language.held_out(F.col("doc_id")))
    return language.identify(docs, samples).select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from spanforge.llm import alignment

    return alignment.align_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), str(public_tokenizers.path("piece_bpe_32k.model")), Shared(spark))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanforge.llm import packing

    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), 0, Shared(spark))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanforge.llm import vector_codes

    shared = Shared(spark)
    return vector_codes.digest(*vector_codes.compress(table(spark, sf_dir, "embeddings"), shared), shared)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_licenses, op3_mixing, op4_decontaminate, op5_substrings, op6_urls, op7_toxicity, op8_token_store, op9_minhash, op10_language, op11_alignment, op12_packing, op13_vector_codes)}


def oracle_sql() -> dict[str, str]:
    from spanforge.llm import decontaminate, minhash, vector_codes

    return {"op4_decontaminate": decontaminate.SQL, "op9_minhash": minhash.SQL, "op13_vector_codes": vector_codes.SQL}
