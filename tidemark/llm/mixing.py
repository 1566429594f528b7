"""Mixing sources to target weights: hierarchical budgeting over a domain-language-source tree.

A token budget goes down the tree by weights. A child whose whole subtree cannot supply its share gives what it
has, and its siblings share the rest by their weights; only what a whole subtree lacks reaches the siblings of
its parent, as the parent's own supply bounds the parent's share. A leaf's budget is filled with whole
seeded epochs and then a prefix of one more epoch: its documents in the order of ``md5(seed|epoch|doc_id)`` as
long as their running token count stays within what is left.

The prefix needs no sort of a leaf: rows fall into buckets by the first hex digits of the order key, bucket sums
give each bucket's start, and only the one bucket in which a leaf's budget ends needs running sums.

A row is decided on by its leaf and id. Rows of one id in different leaves are decided on apart; those in one leaf
tie, and are chosen only if all of them fit, so no budget is exceeded.

Defined results: a null text has no tokens; null domain, language or source is the empty name; unknown names
weigh 1; what weighs 0 gets nothing and supplies nothing, and a negative weight is an error; rows without tokens are
chosen with the tokens around them; an empty table gives an empty result. Clashing column names are kept apart by
reserved names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.runtime import drop, table

DOMAIN = "case when source in ('src0','src1','src2','src3') then 'web' when source in ('src4','src5','src6','src7','src8','src9') then 'books' else 'code' end"
WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 6, "de": 2, "fr": 1, "es": 1}, "source": {"src0": 3}}
#: Share of the corpus's tokens to take, in thousandths; epochs that a leaf may give; seed; hex digits of a bucket.
PERMILLE, EPOCHS, SEED, DIGITS = 500, 3, 17, 3
LEVELS = ["domain", "lang", "source"]
WORD = r"[^\x20\x09-\x0D]+"


def _weight(level: str, weights: dict) -> F.Column:
    known = weights.get(level) or {}
    if any(int(v) < 0 for v in known.values()):
        raise ValueError(f"negative weight of {level}")
    pairs = reduce(lambda w, kv: w.when(F.col(level) == kv[0], F.lit(int(kv[1]))), known.items(), F.when(F.lit(False), F.lit(1)))
    return pairs.otherwise(F.lit(1)).cast("long")


def fill(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Water-filling: adds ``given`` to rows of (parent keys, name, supply, weight, budget of the parent).

    In the order of supply per weight, a child is saturated if its supply is at most its share of what its
    saturated predecessors leave; the others share that by weight, rounded down. A child without weight has no supply.
    """
    keys = parent or [F.lit(0)]
    order = W.partitionBy(*keys).orderBy(F.when(F.col("weight") > 0, F.col("supply").cast("decimal(20,0)") / F.col("weight").cast("decimal(10,0)")), "name")
    whole = W.partitionBy(*keys)
    nodes = nodes.withColumn("s_before", F.coalesce(F.sum("supply").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    nodes = nodes.withColumn("w_from", F.sum("weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing)))
    nodes = nodes.withColumn("full", F.col("supply") * F.col("w_from") <= F.col("weight") * (F.col("budget") - F.col("s_before")))
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("supply"))).over(whole), F.lit(0))
    open_ = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    nodes = nodes.withColumns({"left": left, "open": open_})
    return nodes.withColumn("given", F.when(F.col("full"), F.col("supply")).otherwise(F.expr("(weight * `left`) div `open`"))).drop("s_before", "w_from", "full", "left", "open")


def budgets(leaves: DataFrame, weights: dict, permille: int, epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, given) of every leaf from its tokens."""
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).select(F.expr(f"tokens * {int(permille)} div 1000").alias("budget"))
    some = reduce(lambda a, b: a & b, [_weight(level, weights) > 0 for level in LEVELS])
    supplies = leaves.withColumn("tokens", F.when(some, F.col("tokens")).otherwise(F.lit(0)).cast("long"))
    given = None
    for depth, level in enumerate(LEVELS):
        parent = LEVELS[:depth]
        nodes = supplies.groupBy(*parent, level).agg((F.sum("tokens") * epochs).alias("supply"))
        nodes = nodes.withColumn("weight", _weight(level, weights)).withColumn("name", F.col(level))
        if given is None:
            nodes = nodes.join(F.broadcast(total))  # one row
        else:
            nodes = nodes.join(given.withColumnRenamed("given", "budget"), parent)
        # Written level by level: one plan of all levels' windows is re-planned whole after each of its stages.
        above, given = given, table(fill(nodes, parent).select(*parent, level, "given"), "mix-given")
        if above is not None:
            drop(above)
    return given.join(leaves, LEVELS)


def _leaf(domain: str) -> list[F.Column]:
    """A row's names down the tree."""
    return [F.coalesce(F.expr(domain), F.lit("")).alias("domain"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")]


def mix(docs: DataFrame, domain: str = DOMAIN, weights: dict = WEIGHTS, permille: int = PERMILLE, epochs: int = EPOCHS, seed: int = SEED, digits: int = DIGITS) -> DataFrame:
    """Every row's id, leaf and tokens, the ``whole`` epochs that take it, and whether one ``more`` does."""
    tokens = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = table(docs.select(F.col("doc_id").alias("__id"), *_leaf(domain), tokens.alias("tokens")), "mix-rows")
    leaves = table(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    plan = budgets(leaves, weights, permille, epochs)
    plan = plan.select(*LEVELS, F.when(F.col("tokens") > 0, F.expr("given div tokens")).otherwise(F.lit(0)).alias("whole"), F.when(F.col("tokens") > 0, F.expr("given % tokens")).otherwise(F.lit(0)).alias("rest"), "given")
    plan = table(plan, "mix-plan")  # a row for each leaf
    rows = rows.join(plan, LEVELS)
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("__id").cast("string"), F.lit(""))))
    rows = rows.withColumn("__key", order).withColumn("bucket", F.substring("__key", 1, digits))
    sums = rows.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("n"), F.first("rest").alias("rest"))
    before = W.partitionBy(*LEVELS).orderBy("bucket")
    upto = F.sum("n").over(before)
    sums = sums.withColumn("__upto", upto).withColumn("__before", F.col("__upto") - F.col("n"))
    sums = sums.select(*LEVELS, "bucket", F.when(F.col("__upto") <= F.col("rest"), "in").when(F.col("__before") > F.col("rest"), "out").otherwise("cut").alias("part"), "__before")
    rows = table(rows.join(sums, [*LEVELS, "bucket"]), "mix-keyed")
    running = F.sum("tokens").over(W.partitionBy(*LEVELS, "bucket").orderBy("__key")) + F.col("__before")
    cut = rows.filter(F.col("part") == "cut").withColumn("more", (running <= F.col("rest")) & (F.col("rest") > 0))
    sure = rows.filter(F.col("part") != "cut").withColumn("more", (F.col("part") == "in") & (F.col("rest") > 0))
    drop(leaves)
    return sure.unionByName(cut).select("__id", *LEVELS, "tokens", F.col("whole").cast("int").alias("whole"), "more")


def _spread(df: DataFrame) -> DataFrame:
    """One row for each epoch in which a row is taken."""
    n = F.col("whole") + F.col("more").cast("int")
    return df.filter(n > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), n - 1))).drop("whole", "more")


def mix_documents(docs: DataFrame, domain: str = DOMAIN, **options) -> DataFrame:
    """The documents of the mixture with their own columns, repeated for each epoch that takes them."""
    # Rows of one leaf and id are decided on together.
    taken = mix(docs, domain, **options).groupBy("__id", *LEVELS).agg(F.max("whole").alias("whole"), F.max("more").alias("more"))
    rows = docs.select(F.struct(*docs.columns).alias("__row"), F.col("doc_id").alias("__doc"), *_leaf(domain))  # apart from any name
    same = reduce(lambda a, b: a & b, [rows[x] == taken[x] for x in LEVELS], rows["__doc"].eqNullSafe(taken["__id"]))
    return _spread(rows.join(taken, same).select("__row", "whole", "more")).select("__row.*")


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    """Contract query: the mixture of all documents, a row for each document and epoch."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return _spread(mix(docs)).select(F.col("__id").alias("doc_id"), "domain", "tokens", "epoch")


def oracle(table_sql: str = "documents") -> str:
    """The same in DuckDB SQL, without buckets; columns as in the contract query."""

    def weight(level: str) -> str:
        known = " ".join(f"when '{k}' then {v}" for k, v in WEIGHTS.get(level, {}).items())
        return f"cast(case {level} {known} else 1 end as bigint)"

    sql = f"""with docs as (select doc_id, coalesce({DOMAIN}, '') domain, coalesce(lang, '') lang, coalesce(source, '') source,
        cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) tokens from {table_sql}),
    leaves as (select domain, lang, source, cast(sum(tokens) as bigint) tokens from docs group by all),
    g0 as (select cast(coalesce(sum(tokens), 0) * {PERMILLE} as bigint) // 1000 given from leaves)"""
    for depth, level in enumerate(LEVELS):
        parent = LEVELS[:depth]
        keys = ", ".join(parent) or "1"
        columns = ", ".join([*parent, level])
        join = " and ".join(f"n.{p} = g.{p}" for p in parent) or "true"
        part = f"partition by {keys}"
        sql += f""",
    n{depth} as (select {columns}, cast(sum(tokens) * {EPOCHS} as bigint) supply, {weight(level)} weight from leaves group by {columns}),
    b{depth} as (select n.*, g.given budget from n{depth} n join g{depth} g on {join}),
    o{depth} as (select *, coalesce(sum(supply) over (x rows between unbounded preceding and 1 preceding), 0) s_before,
        sum(weight) over (x rows between current row and unbounded following) w_from from b{depth}
        window x as ({part} order by supply / weight, {level})),
    f{depth} as (select *, supply * w_from <= weight * (budget - s_before) as sated from o{depth}),
    g{depth + 1} as (select {columns}, cast(case when sated then supply else
        (weight * (budget - coalesce(sum(supply) filter (sated) over ({part}), 0))) // sum(weight) filter (not sated) over ({part}) end as bigint) given from f{depth})"""
    return sql + f""",
    plan as (select g3.*, l.tokens, case when l.tokens > 0 then given // l.tokens else 0 end whole, case when l.tokens > 0 then given % l.tokens else 0 end rest
        from g3 join leaves l using (domain, lang, source)),
    keyed as (select d.doc_id, d.domain, d.tokens, whole, rest, sum(d.tokens) over (partition by d.domain, d.lang, d.source
        order by md5(concat('{SEED}|', cast(whole as varchar), '|', coalesce(cast(doc_id as varchar), '')))) running
        from docs d join plan p using (domain, lang, source)),
    taken as (select *, cast(whole as int) + case when rest > 0 and running <= rest then 1 else 0 end n from keyed)
    select doc_id, domain, tokens, cast(unnest(range(n)) as int) epoch from taken where n > 0"""
