"""URL filters by association rules, with DataFrame functions alone.

A URL is cut into tokens: its domain and every parent domain, the words of its host, the segments
of its path and the names of its query's parameters. Of tokens that stand in the same labelled URLs
only one is mined, so that they do not multiply. Spark's FP-growth mines the token combinations of
labelled URLs together with the label. Rules `tokens -> block` and `tokens -> allow` are kept if their support and
confidence suffice, if the label's share among all labelled URLs lies below the Wilson bound of the
confidence (so a rule of few URLs has to be surer, at every size of the table alike), and if no part of
the tokens already gives the same confidence. A rule is filed under its rarest token (an inverted
index), so a URL meets only the rules of its own tokens. It is blocked if the surest block rule
whose tokens are all there is surer than the surest allow rule. Stated rules for hosts and paths come
first; a URL that no rule fits is allowed.

Cases: a null URL, or one without `://`, has no host, path or tokens, so no rule fits and it is
allowed; URLs that repeat are judged once and joined back; very long URLs are cut whole; null labels are left out, and of
several labels of a page the strictest counts; if rules of both kinds are equally sure the URL is allowed;
without labels of both kinds nothing is mined;
pages that repeat each get a row; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.llm.common import Shared

MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.8
Z = 1.96
BLOCK, ALLOW = "label=block", "label=allow"

#: Rules that the contract states: verdict, host, path.
STATED = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def lower(c: Column) -> Column:
    """A-Z alone lower-cased."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rest(url: Column) -> Column:
    """What follows the first ://, else an empty string."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return lower(F.regexp_extract(rest(url), r"^([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(rest(url), r"^[^/?#]*([^?#]*)", 1)


def stated_rule(h: Column, p: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest stated rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, rh, rp in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1:])):
        fits = ((h == rh) | h.endswith(f".{rh}")) & p.startswith(rp)
        name, verdict = F.when(fits, rh + rp).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL."""
    h, p = host(url), path(url)
    parts = F.split(h, r"\.")
    n = F.size(parts)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(parts, i, n), ".")))
    labels = F.transform(F.filter(F.split(h, r"[.\\-]"), lambda x: x != ""), lambda x: F.concat(F.lit("h:"), x))
    segments = F.transform(F.filter(F.split(p, "/"), lambda x: x != ""), lambda x: F.concat(F.lit("p:"), x))
    query = F.regexp_extract_all(F.regexp_extract(rest(url), r"\?([^#]*)", 1), F.lit(r"([^&=]+)=?[^&]*"), 1)
    names = F.transform(query, lambda x: F.concat(F.lit("q:"), x))
    return F.when(h == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(domains, labels, segments, names)))


def thinned(labelled: DataFrame) -> DataFrame:
    """(block, tokens) with one token of those that stand in the same rows.

    A token's rows are known by their number and two sums of hashes over them."""
    row = labelled.select("block", "tokens", F.monotonically_increasing_id().alias("row"))
    row = Shared(labelled.sparkSession).write(row)
    spread = row.select("row", F.explode("tokens").alias("token"))
    sums = spread.groupBy("token").agg(F.count("*").alias("n"), *(F.sum(F.shiftright(F.xxhash64(F.lit(k), "row"), 16)).alias(f"s{k}") for k in (1, 2)))
    one = sums.groupBy("n", "s1", "s2").agg(F.min("token").alias("token")).select("token")
    kept = spread.join(one, "token").groupBy("row").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
    return row.select("row", "block").join(kept, "row").select("block", "tokens")


def wilson(share: Column, n: Column) -> Column:
    """The lower bound of a share of n."""
    middle, spread = share + Z * Z / (2 * n), Z * F.sqrt((share * (1 - share) + Z * Z / (4 * n)) / n)
    return (middle - spread) / (1 + Z * Z / n)


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(antecedent, token, support, confidence, block): pruned rules, each filed under its rarest token.

    labelled: columns tokens and block (boolean)."""
    spark = labelled.sparkSession
    shared = Shared(spark)
    known = thinned(labelled.where("block is not null and size(tokens) > 0").select("block", "tokens"))
    baskets = shared.write(known.select(F.concat("tokens", F.array(F.when(F.col("block"), BLOCK).otherwise(ALLOW))).alias("items")))
    empty = spark.createDataFrame([], "antecedent array<string>, token string, support double, confidence double, block boolean")
    n, blocked = baskets.agg(F.count("*"), F.sum(F.array_contains("items", BLOCK).cast("long"))).first()
    if not n or blocked in (0, n):
        return empty
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence, numPartitions=parts).fit(baskets)
    block = F.array_contains("consequent", BLOCK)
    found = model.associationRules.where(block | F.array_contains("consequent", ALLOW)).select(F.array_sort("antecedent").alias("antecedent"), "support", "confidence", block.alias("block"))
    base = F.when(F.col("block"), blocked / n).otherwise(1 - blocked / n)
    found = found.where(wilson(F.col("confidence"), F.col("support") * n / F.col("confidence")) > base)
    found = shared.write(found.withColumn("id", F.xxhash64("antecedent", "block")))
    # a rule is needless if fewer of its tokens are as sure
    parts = found.select(F.col("antecedent").alias("part"), F.col("antecedent")[0].alias("token"), "block", F.col("confidence").alias("part_confidence"))
    whole = found.select("id", "antecedent", "block", "confidence", F.explode("antecedent").alias("token"))
    needless = whole.join(parts, ["token", "block"]).where((F.size("part") < F.size("antecedent")) & (F.size(F.array_except("part", "antecedent")) == 0) & (F.col("part_confidence") >= F.col("confidence"))).select("id").distinct()
    kept = found.join(needless, "id", "left_anti")
    often = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    filed = kept.select("*", F.explode("antecedent").alias("token")).join(often, "token").groupBy("id").agg(F.min(F.struct("freq", "token")).alias("rare"))
    return shared.write(kept.join(filed, "id").select("antecedent", F.col("rare.token").alias("token"), "support", "confidence", "block"))


def matched(urls: DataFrame, mined: DataFrame) -> DataFrame:
    """(url, mined_block, mined_allow): the confidence of the surest mined rules that fit. urls: distinct urls."""
    spread = urls.select("url", tokens(F.col("url")).alias("tokens")).select("url", "tokens", F.explode("tokens").alias("token"))
    hits = spread.join(mined.select("token", "antecedent", "confidence", "block"), "token").where(F.size(F.array_except("antecedent", "tokens")) == 0)
    return hits.groupBy("url").agg(F.max(F.when(F.col("block"), F.col("confidence"))).alias("mined_block"), F.max(F.when(~F.col("block"), F.col("confidence"))).alias("mined_allow"))


def judge(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]] = STATED, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, mined_block and mined_allow (the confidence of the surest mined rules) of every page.

    labelled: columns url and block, from which rules are mined."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"))
    mined = mine(labelled.where("url is not null").select(tokens(F.col("url")).alias("tokens"), "block"))
    found = matched(rows.where("url is not null").select("url").distinct(), mined)
    u = F.coalesce(F.col("url"), F.lit(""))
    name, verdict = stated_rule(F.col("host"), F.col("path"), rules)
    out = rows.join(found, "url", "left").withColumns({"host": host(u), "path": path(u)})
    method = F.when(F.col("mined_block") > F.coalesce("mined_allow", F.lit(0.0)), "block").otherwise("allow")
    return out.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "mined_block", "mined_allow")
