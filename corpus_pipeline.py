"""The training-data pipeline: reject toxic documents, keep one of each group of near-duplicates,
drop documents that leak benchmark passages, mix sources to target weights, store token ids.

Every stage works on all that the one before kept, written as Parquet and read again. All but the
last return the columns of documents, whatever other columns there are; the last returns the place of
each document in the store. Rows that the mix takes twice appear twice.

Rows are told apart by the file and the place that they stand at, never by what they hold: rows of one
id, equal rows and rows without an id are documents like others. Very long texts are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm import common, decontaminate, minhash, mixing, queries, token_store, toxicity
from spanforge.llm.common import Shared, numbered, table

#: The fit and the flow network are iterative, so SQL cannot express the stages.
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject. It is fitted on the stage's own input.

    A null or empty text has no toxic words and stays; at a probability of exactly one half a document
    goes; without labels of both kinds, or without documents, nothing goes."""
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*(F.col(c).alias(n) for c, n in at.items()), F.col("doc_id").alias("id_"))
    scored = toxicity.score(plain, model, doc_id="id_", text=at["text"], keep=tuple(at.values()))
    return scored.where("not toxic").select(*(F.col(n).alias(c) for c, n in at.items()))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that with the smallest doc_id; of several, that which stands first.

    Documents without an id come after all others; texts without words, nulls among them, are copies of
    nothing and stay; an empty table stays empty."""
    rows, place = numbered(docs, Shared(spark))
    groups = minhash.near_duplicates(rows, common.alnum_hashes, k=5, percent=80, carry=tuple(place))
    first = groups.where("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *place)).alias("first"))
    keep = first.select(*(F.col(f"first.{c}").alias(c) for c in place)).unionByName(groups.where("root is null").select(*place))
    return rows.join(keep, place, "left_semi").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten consecutive words of a benchmark item.

    A null text has no words and stays; without items all stay."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10, carry=tuple(docs.columns))
    return found.where("not contaminated").select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, not at all, once or twice.

    A text without words has size 0 and is taken like others of its source; a null source is a source;
    documents that tie in the order of selection go by id and text; an empty table stays empty."""
    rows, place = numbered(docs, Shared(spark))
    taken, _ = mixing.mix_sources(rows, F.array("source"), carry=tuple(place))
    copies = taken.where("copies > 0").select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(place)), F.col("copies").cast("int").alias(f"{place[0]}_copies"))
    picked = rows.join(copies, place)
    return picked.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(f"{place[0]}_copies"))).alias(f"{place[0]}_copy")).select(*docs.columns)


def store(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of all texts in the store, read back: doc_id, start, n_tokens, ids_crc32.

    A null text is an empty one, of the end id alone; rows of one id each have their place, in the order
    of their texts; an empty table gives no rows."""
    shards = Shared(spark).write(token_store.encode_shards(docs, queries.tokenizer_path(), queries.END_ID))
    return token_store.read_documents(shards)


STAGES = [("toxicity", reject_toxic), ("near_dedup", drop_near_copies), ("decontaminate", drop_leaks), ("mix", mix), ("token_store", store)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    shared = Shared(spark)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = shared.write(docs)
    return docs
