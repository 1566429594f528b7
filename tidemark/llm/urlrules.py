"""URL filtering by association rules.

Two layers, both JVM-side. Listed rules (host suffix and path prefix) judge the URLs they fit; the longest one
wins. For the others, pattern growth mines combinations of URL tokens from labelled URLs; rules that conclude a
label are pruned by support, by confidence and by dropping those that hold a shorter rule of the same
conclusion, and match by an inverted index on their rarest token.

Long URLs do not blow mining up: tokens that stand in exactly the same labelled URLs are one item, which any of them
gives a URL; and itemsets grow item by item to the ``LONGEST`` antecedent only, within the URLs that hold them, where a
longer one can still be a better rule. All items of all labelled URLs are counted.

Defined results: a null URL, or one without ``://``, has an empty host and path, no rule, and the default
verdict; equal URLs get equal verdicts; an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.runtime import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The rules of the contract query: host and path prefix, verdict.
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]

#: Items of the longest antecedent: a parameter of the model.
LONGEST = 4


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path, and what follows the path."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(rest, r"(?s)^[^?#]*(.*)$", 1)
    return F.translate(host, UPPER, LOWER), path, tail


def listed(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest listed rule that fits and its verdict (nulls if none). The rules are a bounded parameter
    list: one literal map from host to its paths, looked up for every suffix of the URL's host."""
    by_host: dict[str, list[str]] = {}
    for rule, _ in rules:
        head, _, tail = rule.partition("/")
        by_host.setdefault(head, []).append("/" + tail)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    table_ = F.create_map(*[x for h, ps in by_host.items() for x in (F.lit(h), F.array(*[F.lit(p) for p in ps]))])
    fits = F.flatten(F.transform(suffixes, lambda s: F.transform(F.filter(F.coalesce(table_[s], F.array().cast("array<string>")), lambda p: F.startswith(path, p)), lambda p: F.concat(s, p))))
    best = F.element_at(F.array_sort(F.transform(fits, lambda r: F.struct((-F.length(r)).alias("n"), r.alias("rule")))), 1)["rule"]
    best = F.when(F.size(fits) > 0, best)
    verdict = F.create_map(*[x for r, v in rules for x in (F.lit(r), F.lit(v))])[best]
    return best, verdict


def tokens(host: Column, path: Column, tail: Column) -> Column:
    """Distinct tokens of a URL: labels of the host by place, hyphen parts of host labels, segments of the path
    without digits, keys of the query, and the fragment."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    back = F.reverse(labels)
    placed = F.transform(back, lambda x, i: F.concat(F.lit("h"), i.cast("string"), F.lit(":"), x))
    parts = F.flatten(F.transform(labels, lambda x: F.transform(F.filter(F.split(x, "-"), lambda y: F.contains(x, F.lit("-")) & (y != "")), lambda y: F.concat(F.lit("w:"), y))))
    steps = F.transform(F.filter(F.split(path, "/"), lambda x: (x != "") & ~x.rlike("[0-9]")), lambda x: F.concat(F.lit("p:"), x))
    shape = F.array(F.concat(F.lit("e:"), F.regexp_extract(path, r"(\.[A-Za-z]+|/)$", 1)))
    keys = F.transform(F.regexp_extract_all(tail, F.lit(r"[?&]([^=&#]+)"), 1), lambda x: F.concat(F.lit("q:"), x))
    return F.array_distinct(F.concat(placed, parts, steps, shape, keys))


def vocabulary(labelled: DataFrame, min_support: float) -> DataFrame:
    """(token, item, freq) of the tokens of labelled (items, verdict) rows that reach ``min_support``.

    ``item``: the least of the tokens that stand in exactly the same rows.
    """
    base = labelled.agg(F.count(F.lit(1)).alias("all"))
    row = F.xxhash64("items", "verdict")
    prints = [F.sum(x.cast("decimal(38,0)")) for x in (row, F.xxhash64(row, F.lit(1)))]
    freq = labelled.withColumn("token", F.explode("items")).groupBy("token").agg(F.count(F.lit(1)).alias("freq"), *[x.alias(f"p{i}") for i, x in enumerate(prints)])
    known = freq.crossJoin(F.broadcast(base)).filter(F.col("freq") >= F.ceil(F.col("all") * min_support))
    return known.select("token", F.min("token").over(W.partitionBy("freq", "p0", "p1")).alias("item"), "freq")


def mine(labelled: DataFrame, words: DataFrame, min_support: float, min_confidence: float, most: int = LONGEST) -> DataFrame:
    """Rules (rule_id, antecedent, anchor, verdict, confidence, support) over the items of ``words`` from labelled
    (items, verdict) rows."""
    rows = labelled.select("items", "verdict", F.xxhash64("items").alias("url"))
    told = rows.select("url", "items").distinct().select("url", F.explode("items").alias("token")).join(words, "token")
    told = told.groupBy("url").agg(F.sort_array(F.collect_set("item")).alias("items"))  # one URL's tokens
    baskets = rows.select("url", "verdict").join(told, "url", "left").groupBy(F.coalesce("items", F.array().cast("array<string>")).alias("items"), "verdict").agg(F.count(F.lit(1)).alias("n"))
    baskets = table(baskets, "url-baskets")
    found = _grown(baskets, min_support, min_confidence, most)
    found = table(found.withColumn("rule_id", _rule_id(F.col("antecedent"))), "url-rules")
    # A rule that holds all items of a shorter one with the same verdict says nothing new: each looks its parts up.
    parts = F.transform(F.expr("sequence(1, cast(pow(2, size(antecedent)) as int) - 2)"), lambda m: F.filter("antecedent", lambda x, i: F.call_function("getbit", m, i) == 1))
    longer = found.filter(F.size("antecedent") > 1).select(F.col("rule_id").alias("longer"), "verdict", F.col("confidence").alias("own"), F.explode(parts).alias("part"))
    held = longer.withColumn("rule_id", _rule_id(F.col("part"))).join(found.select("rule_id", "confidence"), "rule_id").filter(F.col("confidence") >= F.col("own"))
    kept = found.join(held.select(F.col("longer").alias("rule_id")).distinct(), "rule_id", "left_anti")
    rarest = kept.select("rule_id", F.explode("antecedent").alias("token")).join(words, "token").groupBy("rule_id").agg(F.min(F.struct("freq", "token"))["token"].alias("anchor"))
    return table(kept.join(rarest, "rule_id"), "url-index")


def _grown(baskets: DataFrame, min_support: float, min_confidence: float, most: int) -> DataFrame:
    """(antecedent, verdict, confidence, support) of the rules with up to ``most`` items over all (items, verdict, n)
    baskets, but for some that hold a shorter rule of the same verdict and as much confidence.

    An itemset grows only if some verdict has support and not all of its baskets: else no longer one is more confident.
    Nor does it grow if it has as many baskets as without its last item, as that one grows into the same.
    """
    spread = baskets.groupBy("verdict").agg(F.sum("n").alias("rows"))
    base = spread.withColumn("all", F.sum("rows").over(W.partitionBy(F.lit(0))))  # a row for each verdict
    held = baskets.select("items", "verdict", "n", F.lit(None).cast("long").alias("before"), F.explode("items").alias("last")).withColumn("set", F.array("last"))
    found = None
    for size in range(1, most + 1):
        counts = held.groupBy("set", "verdict").agg(F.sum("n").alias("c"), F.min("before").alias("before"))
        freq = counts.groupBy("set").agg(F.sum("c").alias("freq"))
        counts = counts.join(freq, "set").join(F.broadcast(base), "verdict").filter(F.col("c") >= F.ceil(F.col("all") * min_support))
        counts = table(counts, "url-counts")
        confidence = F.col("c") / F.col("freq")
        rules = counts.filter((confidence >= min_confidence) & (confidence / (F.col("rows") / F.col("all")) > 1))
        rules = rules.select(F.col("set").alias("antecedent"), "verdict", confidence.alias("confidence"), (F.col("c") / F.col("all")).alias("support"))
        found = rules if found is None else found.union(rules)
        grows = counts.filter((F.col("c") < F.col("freq")) & (F.col("before").isNull() | (F.col("freq") < F.col("before")))).select("set", "freq").distinct()
        if size == most or grows.isEmpty():
            break
        longer = held.join(grows, "set")
        if size == 1:  # other items can add nothing to any itemset
            some = longer.groupBy(F.col("items").alias("whole"), "verdict", "n").agg(F.sort_array(F.collect_set("last")).alias("items"))
            some = some.groupBy("items", "verdict").agg(F.sum("n").alias("n")).withColumn("last", F.explode("items")).withColumn("set", F.array("last"))
            longer = some.join(grows, "set")
        longer = longer.select("items", "verdict", "n", F.col("freq").alias("before"), "set", F.explode(F.filter("items", lambda x: x > F.col("last"))).alias("next"))
        held = table(longer.select("items", "verdict", "n", "before", F.concat("set", F.array("next")).alias("set"), F.col("next").alias("last")), "url-held")
    return found


def _rule_id(antecedent: Column) -> Column:
    return F.concat_ws(" ", F.col("verdict"), F.array_join(antecedent, " "))


def judge(urls: DataFrame, index: DataFrame, words: DataFrame) -> DataFrame:
    """(url, mined) verdict of the best fitting mined rule for each row of (url, items); rows that none fits are left
    out. Best: highest confidence, then support, then the rule's name."""
    known = urls.select("url", F.explode("items").alias("token")).join(words.select("token", "item"), "token").groupBy("url").agg(F.collect_set("item").alias("items"))
    hit = known.select("url", "items", F.explode("items").alias("anchor")).join(index, "anchor").filter(F.size(F.array_except("antecedent", "items")) == 0)
    return hit.groupBy("url").agg(F.max(F.struct("confidence", "support", "rule_id", "verdict"))["verdict"].alias("mined"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, labels: DataFrame | None = None, min_support: float = 0.01, min_confidence: float = 0.95, default: str = "allow") -> DataFrame:
    """Judge every row's url. ``labels``: (url, verdict) rows to mine from; without it, the URLs that listed
    rules judge are the labelled ones. Returns page_id, url, host, path, rule, verdict, judged_by."""
    host, path, tail = split_url(F.col("url"))
    rows = pages.select("page_id", "url").withColumns({"host": host, "path": path, "tail": tail})
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("listed", F.create_map(*[x for r, v in rules for x in (F.lit(r), F.lit(v))])[F.col("rule")])
    items = tokens(F.col("host"), F.col("path"), F.col("tail"))
    if labels is None:
        labelled = rows.filter(F.col("listed").isNotNull()).select(items.alias("items"), F.col("listed").alias("verdict"))
    else:
        h, p, t = split_url(F.col("url"))
        labelled = labels.filter(F.col("verdict").isNotNull()).select(tokens(h, p, t).alias("items"), "verdict")
    labelled = table(labelled, "url-labelled")
    words = table(vocabulary(labelled, min_support), "url-tokens")
    index = mine(labelled, words, min_support, min_confidence)
    open_ = rows.filter(F.col("listed").isNull() & (F.col("host") != "")).select("url", items.alias("items")).distinct()
    mined = judge(open_, index, words)
    out = rows.join(mined, "url", "left")
    return out.select("page_id", "url", "host", "path", "rule", F.coalesce("listed", "mined", F.lit(default)).alias("verdict"), F.when(F.col("listed").isNotNull(), "listed").when(F.col("mined").isNotNull(), "mined").otherwise("default").alias("judged_by"))


def op4_url_filters(spark, sf_dir: str) -> DataFrame:
    """Contract query: every page's url under the five listed rules, the rest by mined rules."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "judged_by")
