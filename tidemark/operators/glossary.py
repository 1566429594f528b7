"""Glossary operators: index, priority merge, lookup, corpus scan, term checks, category split.

Levels rank L1 before L1.5 before L2; within a level the order of sources, then of rows, decides.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as tx

# Header names by which a glossary's columns are found, in lower case.
EN_NAMES = ["en_us", "english", "full form (english)", "term_en"]
ZH_NAMES = ["zh_cn", "chinese", "term_zh"]
SHORT_NAMES = ["short_form", "short form"]
LEVELS = ["L1", "L1.5", "L2"]
#: Terms up to which one alternation pattern is compiled; of a larger dictionary each text gets its own terms' pattern.
PATTERN_TERMS = 5000


def find_column(columns: list[str], names: list[str], fallback: int | None) -> str | None:
    """The first column whose lower-case name is one of ``names``; else the one at ``fallback``."""
    for c in columns:
        if c.strip().lower() in names:
            return c
    return columns[fallback] if fallback is not None and columns else None


def standard_columns(df: DataFrame, level: str, path: str, source_order: int) -> DataFrame:
    """Any glossary file as level, path, source_order, row_no, term_en, short_form, term_zh."""
    en, zh, short = find_column(df.columns, EN_NAMES, 0), find_column(df.columns, ZH_NAMES, -1), find_column(df.columns, SHORT_NAMES, None)
    row = F.monotonically_increasing_id()  # order within one file
    return df.select(F.lit(level).alias("level"), F.lit(path).alias("path"), F.lit(source_order).alias("source_order"), row.alias("row_no"), F.col(f"`{en}`").alias("term_en"), (F.col(f"`{short}`") if short else F.lit(None).cast("string")).alias("short_form"), F.col(f"`{zh}`").alias("term_zh"))


def level_rank(c: Column) -> Column:
    return F.when(c == "L1", 0).when(c == "L1.5", 1).otherwise(2)


def term_rows(glossary: DataFrame, levels: list[str] | None = None, categories: list[str] | None = None) -> DataFrame:
    """A row for each word form. Filters come before the explode, so they reach the scan. Short forms count if
    they have three characters or a digit."""
    if levels:
        glossary = glossary.filter(F.col("level").isin(levels))
    if categories is not None:
        glossary = glossary.filter((F.col("level") != "L2") | F.col("path").isin(categories))
    short = F.filter(tx.split_terms(F.col("short_form")), lambda t: (F.length(t) >= 3) | t.rlike(r"\d"))
    both = F.concat(F.transform(tx.split_terms(F.col("term_en")), lambda t: F.struct(F.lit(0).alias("kind"), t.alias("term"))), F.transform(short, lambda t: F.struct(F.lit(1).alias("kind"), t.alias("term"))))
    rows = glossary.withColumn("x", F.explode(both))
    return rows.select(F.lower("x.term").alias("term_key"), level_rank(F.col("level")).alias("level_rank"), "level", "source_order", "row_no", F.col("x.kind").alias("kind"), "path", F.coalesce(tx.strip(F.col("term_zh")), F.lit("")).alias("zh"))


def build_index(glossary: DataFrame, levels: list[str] | None = None, categories: list[str] | None = None) -> DataFrame:
    """(term_key, level, path, zh): one winner for each word form, by an aggregate with partial combination."""
    rows = term_rows(glossary, levels, categories)
    rank = F.struct("level_rank", "source_order", "row_no", "kind")
    best = rows.groupBy("term_key").agg(F.min_by(F.struct("level", "path", "zh"), rank).alias("x"))
    return best.select("term_key", "x.level", "x.path", "x.zh")


def query(glossary: DataFrame, term: str) -> DataFrame:
    """Rows whose English cell holds ``term``, case aside, in source order."""
    found = glossary.filter(F.contains(F.lower("term_en"), F.lit(term.lower())))
    return found.select("level", "path", "source_order", "row_no", "term_en", "term_zh").orderBy(level_rank(F.col("level")), "source_order", "row_no")


def scan(rows: DataFrame, index: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """Hits (key..., term_key, level, path, zh) of dictionary terms in texts: longest first, word-bounded, not
    overlapping, one for each row and term.

    A dictionary up to ``PATTERN_TERMS`` terms is one alternation pattern over the text; a larger one is met by
    the text's tokens in a join, so nothing of unbounded size goes to the driver.
    """
    few = index.select("term_key").limit(PATTERN_TERMS + 1).collect()
    if len(few) <= PATTERN_TERMS:
        terms = sorted((r[0] for r in few), key=lambda t: (-len(t), t))
        if not terms:
            return rows.select(*key).limit(0).join(index, F.lit(False))
        pattern = F.lit(OPEN + "|".join(re.sub(SPECIAL, r"\\\1", t) for t in terms) + CLOSE)
        return _matches(rows.select(*key, F.col(text).alias("__text")), pattern, key).join(index, "term_key")
    return scan_grams(rows, index, key, text)


#: The pattern of terms: bounded by ASCII letters and digits only, so that a term inside Chinese text is one.
OPEN, CLOSE = r"((?iu)(?<![A-Za-z0-9])(?:", r")(?![A-Za-z0-9]))"
SPECIAL = r"([\\.\[\]{}()*+?^$|\-])"


def _matches(rows: DataFrame, pattern: Column, key: list[str]) -> DataFrame:
    return rows.select(*key, F.explode(F.array_distinct(F.transform(F.regexp_extract_all("__text", pattern, 1), F.lower))).alias("term_key"))


def _fold(c: Column) -> Column:
    """Lower case in which characters that the pattern takes for one another are equal."""
    return F.translate(F.lower(F.translate(c, "ſıİ\u212a", "siik")), "ς", "σ")


def _tokens(c: Column, heads: bool) -> Column:
    """Tokens of folded text by which its terms are found: runs of ASCII letters and digits, which a bounded term
    holds whole; for terms without any, all pairs of other characters and single ones."""
    runs = F.regexp_extract_all(c, F.lit("([a-z0-9]+)"), 1)
    others = [F.regexp_extract_all(c, F.lit(p), 1) for p in (r"(?=([^a-z0-9]{2}))", r"([^a-z0-9])")]
    return F.array_distinct(F.concat(runs, *others) if heads else runs)


def scan_grams(rows: DataFrame, index: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """The same by tokens: each text's candidates are the terms whose rarest token it has; those that it holds
    literally are matched by the same pattern, made for that text."""
    folded = _fold(F.col("term_key"))
    runs = index.select("term_key", F.explode(_tokens(folded, False)).alias("__token"))
    common = runs.groupBy("__token").agg(F.count(F.lit(1)).alias("n"))
    known = runs.join(common, "__token").groupBy("term_key").agg(F.min_by("__token", F.struct("n", "__token")).alias("__token"))
    bare = index.filter(~folded.rlike("[a-z0-9]") & (F.length("term_key") > 0)).select("term_key", F.substring(folded, 1, 2).alias("__token"))
    heads = bare.limit(1).count() > 0
    known = known.union(bare)
    whole = rows.select(*key, F.col(text).alias("__text"), F.xxhash64(text).alias("__hash"))
    found = whole.select("__hash", F.explode(_tokens(_fold(F.col("__text")), heads)).alias("__token")).join(known, "__token")
    # Equal texts share their candidates; too many candidates do no harm.
    found = found.groupBy("__hash").agg(F.collect_set("term_key").alias("__terms"))
    held = F.filter("__terms", lambda t: F.contains(F.col("__folded"), _fold(t)))
    order = F.array_sort(F.transform(held, lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t"))))
    escaped = F.transform(order, lambda x: F.regexp_replace(x["t"], SPECIAL, r"\\$1"))
    both = whole.join(found, "__hash").withColumn("__folded", _fold(F.col("__text"))).select(*key, "__text", escaped.alias("__terms")).filter(F.size("__terms") > 0)
    return _matches(both, F.concat(F.lit(OPEN), F.array_join("__terms", "|"), F.lit(CLOSE)), key).join(index, "term_key")


def _ascii_runs(folded: Column, pattern: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(folded, F.lit(f"({pattern}+)"), 1))


def _heads(folded: Column, others: str) -> Column:
    """Characters by which forms without ASCII runs are found; case variants of one are equal."""
    return F.array_distinct(F.transform(F.regexp_extract_all(folded, F.lit(f"({others})"), 1), lambda x: F.lower(F.upper(x))))


def _candidates(forms: DataFrame, texts: DataFrame) -> DataFrame:
    """(__hash, line): terms that a text may hold, by a token of one of their forms: the rarest run of ASCII letters
    and digits (of letters where spaces are left out), else the first character. ``forms`` (line, form), ``texts``
    (__hash, text, compact). A bounded form's runs are whole in the text but for a plural ending.
    """
    tight = forms.filter(~F.col("form").rlike("[ -]")).select("line", tx.compact(F.col("form")).alias("form"))
    found = None
    for side, column, run, others in ((forms, "text", "[a-z0-9]", "[^a-z0-9]"), (tight, "compact", "[a-z]", "[^a-z]")):
        folded = _fold(F.col("form"))
        runs = side.select("line", "form", F.explode(_ascii_runs(folded, run)).alias("word"))
        known = _rarest(runs, ["line", "form"]).select("line", "word")
        bare = side.filter(~folded.rlike(run) & (F.length("form") > 0)).select("line", F.element_at(_heads(folded, others), 1).alias("word"))
        text = _fold(F.col(column))
        tokens = _ascii_runs(text, run)
        if column == "text":
            tokens = F.array_distinct(F.concat(tokens, F.transform(tokens, lambda t: F.regexp_replace(t, "s$", "")), F.transform(tokens, lambda t: F.regexp_replace(t, "es$", ""))))
        if bare.limit(1).count():
            tokens = F.concat(tokens, _heads(text, others))
        hits = texts.select("__hash", F.explode(tokens).alias("word")).join(known.union(bare), "word").select("__hash", "line")
        found = hits if found is None else found.union(hits)
    return found.distinct()


def _rarest(runs: DataFrame, by: list[str], token: str = "word") -> DataFrame:
    """(by..., token): of each form's tokens the one that the fewest rows have, so that common words join nothing."""
    common = runs.groupBy(token).agg(F.count(F.lit(1)).alias("__n"))
    return runs.join(common, token).groupBy(*by).agg(F.min_by(token, F.struct("__n", token)).alias(token))


def longer_terms(terms: DataFrame) -> DataFrame:
    """(line, longer_line): terms a form of which stands as a word inside a form of another term.

    The inverted index is on words: a form meets only the terms that have its rarest word.
    """
    forms = terms.select("line", F.explode(tx.term_forms(F.col("en"))).alias("form"))
    first = _rarest(forms.select("line", "form", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("form"), F.lit(r"([\p{L}\p{N}_]+)"), 1))).alias("word")), ["line", "form"])
    other = forms.select(F.col("line").alias("longer_line"), F.col("form").alias("longer"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower("form"), F.lit(r"([\p{L}\p{N}_]+)"), 1))).alias("token"))
    # The short form's last word may carry a plural ending, and so may a single-word form's first.
    bare = F.regexp_replace("token", "(?:es|s)$", "")
    keyed = other.select("longer_line", "longer", F.explode(F.array_distinct(F.array("token", bare, F.regexp_replace("token", "s$", "")))).alias("word"))
    both = first.join(keyed, "word").filter(F.col("line") != F.col("longer_line"))
    return both.filter(F.expr("longer rlike concat('(?iuU)\\\\b', regexp_replace(form, '([\\\\\\\\.\\\\[\\\\]{}()*+?^$|\\\\-])', '\\\\\\\\$1'), '(?:es|s)?\\\\b')")).select("line", "longer_line").distinct()


def check_terms(terms: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """Status of each term and chunk: hit, miss, covered or absent.

    ``terms`` (line, en, zh), ``source``/``target`` (doc_id, chunk_no, text). A term is located by its forms as
    words, or by the text without spaces; where only a longer term holds it, it is covered; else its translation, or a
    variant of it, must stand in the target chunk. Chunks meet only the terms that share a token with them, in an
    equi join. A form of hyphens alone is located as a word only.
    """
    forms = terms.withColumn("forms", tx.term_forms(F.col("en"))).filter(F.size("forms") > 0)
    # Equal texts are located once; only the result meets their chunks.
    texts = source.select("text").distinct().withColumn("compact", tx.compact(F.col("text"))).withColumn("__hash", F.xxhash64("text"))
    pattern = F.transform("forms", lambda f: tx.word_pattern(f))
    tight = F.transform(F.filter("forms", lambda f: ~f.rlike("[ -]") & (tx.compact(f) != "")), lambda f: tx.compact_pattern(f))
    keyed = forms.select("line", F.transform(tx.translation_forms(F.col("zh")), tx.norm_zh).alias("zhs"), pattern.alias("pats"), tight.alias("tights"))
    near = _candidates(forms.select("line", F.explode("forms").alias("form")), texts.select("__hash", "text", "compact"))
    both = texts.join(near, "__hash").drop("__hash").join(keyed, "line")
    located = both.filter(F.expr("exists(pats, p -> text rlike p) or exists(tights, p -> compact rlike p)"))
    longer = longer_terms(terms).join(forms.select(F.col("line").alias("longer_line"), F.col("forms").alias("longer_forms")), "longer_line").groupBy("line").agg(F.flatten(F.collect_list("longer_forms")).alias("covers"))
    located = located.join(longer, "line", "left")
    removed = F.expr("aggregate(array_sort(coalesce(covers, array()), (a, b) -> length(b) - length(a)), text, (t, f) -> regexp_replace(t, concat('(?iuU)\\\\b', regexp_replace(f, '([\\\\\\\\.\\\\[\\\\]{}()*+?^$|\\\\-])', '\\\\\\\\$1'), '(?:es|s)?\\\\b'), ' '))")
    located = located.withColumn("rest", removed)
    covered = F.col("covers").isNotNull() & ~F.expr("exists(pats, p -> rest rlike p)")
    located = located.select("text", "line", "zhs", covered.alias("covered"))
    translated = target.select("doc_id", "chunk_no", tx.norm_zh(F.coalesce("text", F.lit(""))).alias("translated"))
    done = source.select("doc_id", "chunk_no", "text").join(translated, ["doc_id", "chunk_no"], "left").join(located, "text")
    found = F.exists("zhs", lambda z: F.contains(F.coalesce("translated", F.lit("")), z))
    status = F.when(F.col("covered"), "covered").when(found, "hit").otherwise("miss")
    seen = done.select("line", "doc_id", "chunk_no", status.alias("status"))
    absent = forms.join(located.select("line").distinct(), "line", "left_anti").select("line", F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("chunk_no"), F.lit("absent").alias("status"))
    return seen.select("line", F.col("doc_id").cast("bigint").alias("doc_id"), F.col("chunk_no").cast("bigint").alias("chunk_no"), "status").unionByName(absent)


def split_categories(rows: DataFrame, column: str = "category") -> DataFrame:
    """A row for each of a row's categories (parted by ;), 'uncategorized' if it has none."""
    parts = F.filter(F.transform(F.split(F.coalesce(column, F.lit("")), ";"), tx.strip), lambda x: x != "")
    return rows.withColumn(column, F.explode(F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("uncategorized")))))


def classify_keys(entries: DataFrame, patterns: dict[str, list[str]]) -> DataFrame:
    """(category, ...) for each category one of whose patterns matches a whole key; a key may be in several. The
    patterns are a parameter: one expression, no join."""
    hits = F.array(*[F.when(F.col("key").rlike("^(?:" + "|".join(ps) + ")$"), F.lit(c)) for c, ps in patterns.items()])
    return entries.withColumn("category", F.explode(F.filter(hits, lambda c: c.isNotNull())))


def pivot_languages(entries: DataFrame, languages: list[str], by: list[str]) -> DataFrame:
    """A column for each language, '' where it has no text: one aggregation, no join for each language."""
    cells = [F.coalesce(F.min(F.when(F.col("lang") == x, F.col("text"))), F.lit("")).alias(x) for x in languages]
    return entries.groupBy(*by).agg(*cells)

