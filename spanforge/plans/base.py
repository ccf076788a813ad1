"""A registry of named queries, and the input they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that says the same if there is any."""

    def add(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            SQL[key] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows of a table whose files are few and small, dealt over tasks by a key before work that costs far more a row than reading it."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), key)


#: Rows of the tables that one task sorts or groups.
TASK_ROWS = 500_000


def dealt(df: DataFrame, *tables: DataFrame) -> int:
    """Tasks over which the rows of tables as they are stored are dealt by a key: as many as the session shuffles to, and more where they would have over TASK_ROWS each.

    A number that is given is not made smaller by the size of the files, which tells little of what rows of few bytes take in a sort."""
    rows = sum(t.count() for t in (df, *tables))
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


#: A clause of each line item. The key repeats, so lines are ranked by everything that tells them apart.
CLAUSES = """clauses AS (
  SELECT l_orderkey AS doc_id, l_linenumber AS line, l_quantity, l_shipdate, l_extendedprice, l_discount, l_partkey, l_suppkey, l_tax,
         concat('Section ', CAST(l_linenumber AS varchar), '.', lpad(CAST(CAST(l_quantity AS int) AS varchar), 2, '0'), ' $', CAST(CAST(l_extendedprice AS decimal(14,2)) AS varchar),
                ' at ', CAST(CAST(round(l_discount * 100) AS int) AS varchar), '% due ', strftime(l_shipdate, '%B %-d, %Y')) AS text
  FROM lineitem)"""


def clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    text = F.concat(
        F.lit("Section "), F.col("l_linenumber").cast("string"), F.lit("."), F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0"), F.lit(" $"), F.col("l_extendedprice").cast("decimal(14,2)").cast("string"),
        F.lit(" at "), F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("% due "), F.date_format("l_shipdate", "MMMM d, yyyy"),
    )
    return li.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("line"), "l_quantity", "l_shipdate", "l_extendedprice", "l_discount", "l_partkey", "l_suppkey", "l_tax", text.alias("text"))
