"""URL filters: a list of (host, path) rules, and association rules mined for the rest.

A URL's host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; the path goes on up to ``?``, ``#`` or the end. A null URL or one without
``://`` has neither. A list rule fits its host and all subdomains if the path starts with
the rule's; the longest fitting rule (host and path together, then the first by name)
decides.

The URLs that the list decides are the labels from which the method learns to judge the
others: Spark's FP-growth mines combinations of URL tokens (scheme, labels of the host with
its last one marked, words of the path, names in the query) that go with a verdict. A rule
is kept if at least ``min_share`` of the labelled URLs (and ``min_count`` of them) hold it,
its confidence is at least ``confidence``, it has at most three items, and no rule on a part
of its items gives the same verdict with no less confidence. Rules are matched by an
inverted index: each is posted under its rarest item, the items of all URLs meet the
postings, and a rule fits if the URL holds all its items. Of the fitting rules the one
of the highest confidence decides (then more support, block before allow, by name); a URL
without any is allowed.

FP-growth and matching see each URL once, however many rows hold it, so a group of copies
weighs as one. Tokens found in just the same labelled URLs are one item, since otherwise a
path shared by many would multiply the combinations: they are told by count and two sums of
URL hashes, and the first by name names the item. A URL holds an item if it holds any token
of it, so rules mean what they would mean for each token by itself.

DataFrame functions only. Every row of the input gives a row; repeated rows each get theirs;
extra columns pass in ``row``. Without labels of any kind nothing is mined. Nulls and empty
URLs are judged by the list on empty host and path, and have no tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridops.llm import common as c

#: Longest antecedent of a mined rule.
MOST_TOKENS = 3


def url_list(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rules as a frame."""
    rows = [F.struct(F.lit(host).alias("host"), F.lit(path).alias("path"), F.lit(verdict).alias("verdict")) for host, path, verdict in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


_HOST = r"(?s)^.*?://([^/?#]*)"
_PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
_QUERY = r"(?s)^.*?://[^?#]*[?]([^#]*)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def parsed(url: str = "url") -> dict:
    """host and path of a URL column (null: empty)."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(text, _HOST, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {"host": host, "path": F.regexp_extract(text, _PATH, 1)}


def decided(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (url, host, path; each once) with ``rule`` and ``listed``, the verdict, of the
    longest list rule that fits, or nulls. A URL meets the rules of its host's suffixes."""
    rules = rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), "verdict")
    most = rules.agg(F.max(F.size(F.split("r_host", "[.]")))).first()[0] or 1
    labels = "split(host, '[.]')"
    suffixes = F.expr(f"transform(sequence(greatest(1, size({labels}) - {most - 1}), size({labels})), i -> array_join(slice({labels}, i, size({labels})), '.'))")
    met = urls.withColumn("r_host", F.explode(suffixes)).join(rules, "r_host").filter("startswith(path, r_path)")
    name = F.concat("r_host", "r_path")
    best = met.groupBy("url").agg(F.min(F.struct((-F.length(name)).alias("size"), name.alias("rule"), F.col("verdict").alias("listed"))).alias("best"))
    return urls.join(best, "url", "left").select("url", "host", "path", "best.rule", "best.listed")


def tokens(url: str = "url", host: str = "host", path: str = "path") -> Column:
    """The distinct tokens of a URL, each with the part of the URL it is from."""
    none = "cast(array() as array<string>)"
    labels = f"filter(split({host}, '[.]'), x -> x <> '')"
    last = f"if(size({labels}) > 0, array(concat('.', element_at({labels}, -1))), {none})"
    words = f"regexp_extract_all(translate({path}, {_LOWER}), '[^/._~!$&()*+,;=:@%-]+', 0)"
    names = f"filter(split(regexp_extract({url}, '{_QUERY}', 1), '&'), x -> x <> '')"
    scheme = f"if(instr({url}, '://') > 0, array(concat(':', translate(substring_index({url}, '://', 1), {_LOWER}))), {none})"
    return F.expr(f"""array_distinct(concat({scheme}, transform({labels}, x -> concat('@', x)), {last},
        transform({words}, x -> concat('/', x)), transform({names}, x -> concat('?', substring_index(x, '=', 1)))))""")


def mine(labelled: DataFrame, min_share: float = 0.005, min_count: int = 5, confidence: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """From ``labelled`` (url, tokens, verdict): rules (needed, an array of items, verdict,
    support, confidence), and the items (token, item)."""
    spark = labelled.sparkSession
    empty = labelled.limit(0).select(F.col("tokens").alias("needed"), "verdict", F.lit(0).cast("long").alias("support"), F.lit(0.0).alias("confidence"))
    total = labelled.count()
    least = max(min_count, -(-total * round(min_share * 1_000_000) // 1_000_000))
    held = labelled.select("url", "verdict", F.explode("tokens").alias("token"))
    h = [F.sum(F.xxhash64("url", F.lit(seed)).cast("decimal(38,0)")).alias(f"h{seed}") for seed in (1, 2)]
    common = c.written(held.groupBy("token").agg(F.count("*").alias("n"), *h).filter(F.col("n") >= least), "url-tokens")
    names = common.groupBy("n", "h1", "h2").agg(F.min("token").alias("item"))
    items = c.written(common.join(names, ["n", "h1", "h2"]).select("token", "item"), "url-items")
    baskets = held.join(items, "token").groupBy("url", "verdict").agg(F.collect_set("item").alias("tokens"))
    baskets = c.written(baskets.select(F.concat("tokens", F.array(F.concat(F.lit("="), "verdict"))).alias("items")), "url-baskets")
    n = baskets.count()
    if n < least:
        return empty, items
    # half a row below the least count, so that the rounding of the share cannot move it
    growth = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, numPartitions=int(spark.conf.get("spark.sql.shuffle.partitions")))
    sets = growth.fit(baskets).freqItemsets
    sets = sets.filter(F.size("items") <= MOST_TOKENS + 1).select(F.array_sort("items").alias("items"), "freq")
    sets = c.written(sets, "url-itemsets")
    marked = sets.select(F.expr("filter(items, x -> startswith(x, '='))").alias("mark"), F.expr("filter(items, x -> not startswith(x, '='))").alias("needed"), "freq")
    whole = marked.filter("size(mark) = 0").select("needed", F.col("freq").alias("held"))
    rules = marked.filter(f"size(mark) = 1 and size(needed) between 1 and {MOST_TOKENS}").join(whole, "needed")
    rules = rules.select("needed", F.expr("substring(mark[0], 2)").alias("verdict"), F.col("freq").alias("support"), (F.col("freq") / F.col("held")).alias("confidence"))
    rules = c.written(rules.filter(F.col("confidence") >= confidence), "url-rules")
    # all true parts of up to three items
    parts = """concat(transform(needed, x -> array(x)), if(size(needed) < 3, cast(array() as array<array<string>>),
        transform(needed, x -> filter(needed, y -> y <> x))))"""
    wider = rules.filter("size(needed) > 1").withColumn("part", F.explode(F.expr(parts)))
    shorter = rules.select(F.col("needed").alias("part"), "verdict", F.col("confidence").alias("c2"))
    idle = wider.join(shorter, ["part", "verdict"]).filter("c2 >= confidence").select("needed", "verdict").distinct()
    return rules.join(idle, ["needed", "verdict"], "left_anti"), items


def matched(urls: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """(url, mined): the verdict of the best of the ``rules`` that fit, for URLs (url, tokens;
    each once) that any fits, by an inverted index under each rule's rarest item."""
    weights = rules.select("support", F.explode("needed").alias("item")).groupBy("item").agg(F.max("support").alias("n"))
    posted = rules.withColumn("item", F.explode("needed")).join(weights, "item")
    index = posted.groupBy("needed", "verdict", "support", "confidence").agg(F.min(F.struct("n", "item"))["item"].alias("item"))
    index = c.written(index, "url-index")
    holding = urls.select("url", F.explode("tokens").alias("token")).join(items, "token").groupBy("url").agg(F.collect_set("item").alias("items"))
    met = holding.withColumn("item", F.explode("items")).join(index, "item").filter("size(array_except(needed, items)) = 0")
    order = F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), (F.col("verdict") != "block").alias("v"), F.col("needed"), F.col("verdict"))
    return met.groupBy("url").agg(F.min(order)["verdict"].alias("mined"))


def judge(pages: DataFrame, rules: DataFrame, keep: list[str] | None = None, min_share: float = 0.005, min_count: int = 5, confidence: float = 0.8) -> DataFrame:
    """``row`` (a struct of the columns in ``keep``, by default all), host, path, ``rule`` (of
    the list, or null), ``verdict``, and ``how``: list, mined or default."""
    rows = pages.select(F.struct(*(keep or pages.columns)).alias("row"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    urls = rows.select("url").distinct().withColumns(parsed())
    urls = c.written(decided(urls, rules).withColumn("tokens", tokens()), "urls")
    mined, items = mine(urls.filter("listed is not null").select("url", "tokens", F.col("listed").alias("verdict")), min_share, min_count, confidence)
    found = matched(urls.filter("listed is null").select("url", "tokens"), mined, items)
    verdicts = urls.join(found, "url", "left").select(
        "url", "host", "path", "rule",
        F.coalesce("listed", "mined", F.lit("allow")).alias("verdict"),
        F.when(F.col("listed").isNotNull(), "list").when(F.col("mined").isNotNull(), "mined").otherwise("default").alias("how"),
    )
    return rows.join(c.written(verdicts, "url-verdicts"), "url").select("row", "host", "path", "rule", "verdict", "how")
