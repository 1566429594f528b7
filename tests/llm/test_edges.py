"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for every operator."""

import gzip
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.llm import bytecnn, decontaminate, mixing, neardup, quality_rules, sharding, substring, toxicity, urlrules, warc
from tidemark.llm.runtime import fresh

LONG = " ".join(f"word{i % 997}x{i % 31}" for i in range(60_000))
TEXT = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty twentyone"
ROWS = [(1, TEXT, "en", "src0"), (1, TEXT, "en", "src0"), (2, TEXT, None, None), (3, None, "de", "src1"), (4, "", "de", "src1"), (5, " \n\t ", "fr", "src5"), (6, LONG, "en", "src2"), (None, "no id here at all", "en", "src0"), (None, None, None, None), (7, "x", "en", "src0")]
#: Names that operators use inside.
CLASH = ["id", "n", "n_words", "size", "shard", "slot", "text_crc32", "digest", "host", "key", "doc", "spans", "bucket", "tokens", "domain", "epoch", "score", "kept", "component_id", "__id", "__key", "__tokens", "line", "sig", "item_id", "at", "whole", "more", "rest", "given"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality", "toxic", F.lit(1).alias("text"), F.lit(2).alias("y"))


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=str)


ALL = sorted((r[0] for r in ROWS), key=str)


def test_mixing(docs):
    out = mixing.mix_documents(docs, permille=1000)
    assert out.columns == docs.columns
    got = out.collect()
    assert {r["doc_id"] for r in got} <= set(ALL)
    assert mixing.mix_documents(docs.limit(0)).count() == 0


def test_substring(docs):
    out = {r["doc_id"]: r for r in substring.remove_repeats(docs).collect()}
    assert out[1]["n_removed"] == 0 and out[2]["n_removed"] == out[2]["n_words"] == 21 and out[2]["kept_text"] == ""
    assert out[3]["n_words"] == out[4]["n_words"] == out[5]["n_words"] == 0 and out[6]["n_words"] == 60_000
    assert ids(substring.remove_repeats(docs)) == ALL
    assert substring.remove_repeats(docs.limit(0)).count() == 0


def test_warc(spark):
    rows = [(1, "http://a/x", "p" * 2000), (2, "http://a/y", "p" * 2000), (3, None, None), (4, "u\r\nX: y", "WARC/1.0\r\n\r\nContent-Length: 5\r\n\r\n"), (5, "", "short"), (6, "http://b", "short"), (None, "http://c", "né"), (7, "http://d", "y" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", F.lit("c").alias("digest"), F.lit("c").alias("head"), F.lit("c").alias("bytes"))
    path = fresh(spark, "edge-warc")
    warc.write_warc(pages, path)
    got = {r["request"]["record_id"]: r for r in warc.assemble(warc.read_warc(spark, path)).collect()}
    assert len(got) == len(rows) and all(r["metadata"] and r["response"] for r in got.values())
    texts = sorted(r["response"]["content"] for r in got.values() if r["response"]["type"] == "response")
    assert texts == sorted(h or "" for p, _, h in rows if p != 1)
    assert [r["response"]["type"] for r in got.values()].count("revisit") == 1
    empty = fresh(spark, "edge-warc")
    warc.write_warc(pages.limit(0), empty)
    assert warc.assemble(warc.read_warc(spark, empty)).count() == 0


def test_equal_pages_are_captures_of_their_own(spark, tmp_path):
    big, other = "z" * 1500, "q" * 1200
    rows = [(1, big)] * 2 + [(2, big)] * 3 + [(3, "s"), (3, "s"), (4, other), (5, other), (None, other), (None, other), (None, "k" * 1000), (None, "k" * 1000), (6, None)]
    spark.createDataFrame([(i, f"http://h/{i}", t) for i, t in rows], "page_id long, url string, html string").repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    got = Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.op3_warc(spark, str(tmp_path)).collect())
    want = {(1, 1500, "revisit", 2): 2, (2, 1500, "response", None): 3, (3, 1, "response", None): 2, (4, 1200, "revisit", 5): 1, (5, 1200, "response", None): 1, (None, 1200, "revisit", 5): 2, (None, 1000, "response", None): 2, (6, 0, "response", None): 1}
    assert got == want


def _record(kind, own, body, *concurrent, length=None):
    head = [f"WARC/1.1\r\nWARC-Type: {kind}", f"WARC-Record-ID: {own}", *(f"WARC-Concurrent-To: {c}" for c in concurrent), f"Content-Length: {len(body) if length is None else length}"]
    return ("\r\n".join(head) + "\r\n\r\n" + body + "\r\n\r\n").encode()


def test_broken_archives(spark, tmp_path):
    records = [_record("response", f"<{i}>", f"body {i} " * 300) for i in range(6)]
    bad = _record("response", "<bad>", "x", length="12x")
    members = [gzip.compress(r) for r in records]
    spoiled = bytearray(members[2])
    spoiled[40:60] = bytes(20)
    (tmp_path / "plain.warc").write_bytes(bad + records[0] + bad + records[1])
    (tmp_path / "cut.warc.gz").write_bytes(b"".join(members[:3]) + members[3][:-30])
    (tmp_path / "spoiled.warc.gz").write_bytes(members[0] + members[1] + bytes(spoiled) + members[4] + b"\0\0" + members[5])
    got = warc.read_warc(spark, str(tmp_path)).select("record_id", "content").collect()
    whole = Counter(r["record_id"] for r in got if r["content"] == f"body {r['record_id'][1]} " * 300)
    assert whole["<0>"] == 3 and whole["<1>"] == 3 and whole["<2>"] == 1 and whole["<4>"] == whole["<5>"] == 1 and "<bad>" not in whole
    assert list(warc.parse_records(b"junk WARC/1.0 \r\n\r\n")) == [] and list(warc.parse_records(b"")) == []


def test_chained_and_several_identifiers(spark, tmp_path):
    records = [_record("request", "<q>", "ask"), _record("response", "<r>", "page", "<q>"), _record("metadata", "<m>", "note", "<r>", "<q>")]
    records += [_record("response", "<r2>", "page"), _record("metadata", "<m2>", "note", "<r2>"), _record("metadata", "<lost>", "note", "<gone>"), _record("metadata", "<self>", "note", "<self>")]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    got = {r["capture_id"]: r for r in warc.assemble(warc.read_warc(spark, str(tmp_path))).collect()}
    assert set(got) == {"<r>", "<r2>", "<gone>", "<self>"} and got["<r>"]["records"] == 3
    assert got["<r>"]["request"]["record_id"] == "<q>" and got["<r>"]["metadata"]["record_id"] == "<m>" and got["<gone>"]["response"] is None


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "HTTP://WWW.Example.COM/en/?q=1#f"), (4, "http://Example.com/en/x"), (5, "http://example.com"), (5, "http://example.com"), (None, "http://x.net/es/"), (6, "a://b://c/d?e"), (7, "http://x.org/" + "a/" * 3000), (8, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string").select("*", F.lit("c").alias("host"), F.lit("c").alias("path"), F.lit("c").alias("items"), F.lit("c").alias("rule"))
    got = {(r["page_id"], r["url"]): (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlrules.filter_urls(pages).collect()}
    assert got[(1, None)] == ("", "", None, "allow") and got[(2, "no scheme")][:3] == ("", "", None)
    assert got[(3, rows[2][1])] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert got[(4, rows[3][1])] == ("example.com", "/en/x", "example.com/en/", "block")
    assert got[(5, rows[4][1])] == ("example.com", "", None, got[(5, rows[4][1])][3]) or got[(5, rows[4][1])][2] in (None, "com/")
    assert got[(None, "http://x.net/es/")][2:] == ("net/es/", "block") and got[(6, rows[7][1])][:2] == ("b:", "//c/d")
    assert urlrules.filter_urls(pages).count() == len(rows)
    assert urlrules.filter_urls(pages.limit(0)).count() == 0


def test_toxicity(docs, labels):
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model)
    assert ids(out) == ALL and out.filter("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.remove_toxic(docs, labels).columns == docs.columns
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.score(docs, toxicity.train(docs, labels.limit(0))).count() == len(ROWS)


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([(1, TEXT), (2, None), (3, ""), (None, "a b"), (1, TEXT), (4, "zz")], "item_id long, text string").select("*", F.lit(1).alias("id"), F.lit(1).alias("doc_id"))
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, bench).collect()} == {(1, 1), (2, 1)}
    assert ids(decontaminate.remove_leaks(docs, bench)) == sorted((i for i in ALL if i not in (1, 2)), key=str)
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


def test_sharding(docs):
    out = sharding.shard(docs, 4).collect()
    assert sorted((r["doc_id"] for r in out), key=str) == ALL
    for s in range(4):
        slots = sorted(r["slot"] for r in out if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert len({r["shard"] for r in out if r["doc_id"] in (1, 2)}) == 1
    assert sharding.shard(docs.limit(0), 4).count() == 0


def test_near_dedup(docs):
    got = neardup.group(docs)
    assert ids(got) == ALL
    by = {r["doc_id"]: r for r in got.collect()}
    assert by[1]["component_id"] == by[2]["component_id"] == 1 and not by[2]["kept"] and by[1]["kept"]
    assert by[3]["n_shingles"] == by[4]["n_shingles"] == by[5]["n_shingles"] == 0 and by[7]["n_shingles"] == 1
    kept = neardup.deduplicate(docs)
    assert kept.columns == docs.columns and ids(kept).count(1) == 1 and 2 not in ids(kept)
    assert neardup.group(docs.limit(0)).count() == 0


def test_quality_rules(docs):
    out = quality_rules.judge(docs)
    assert ids(out) == ALL
    by = {r["doc_id"]: r for r in out.collect()}
    assert by[3]["base_failed"] and not by[3]["kept"] and by[1]["kept"] and by[1]["word_chars"] == len(TEXT.replace(" ", ""))
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_classifier(docs, labels):
    net = bytecnn.train(docs, labels)
    out = bytecnn.score(docs, net)
    assert ids(out) == ALL and out.filter("score is null or score < 0 or score > 1").count() == 0
    by = {r["doc_id"]: r["score"] for r in out.filter("doc_id is not null").collect()}
    assert by[3] == by[4] and by[1] == pytest.approx(by[2])
    assert bytecnn.score(docs.limit(0), net).count() == 0


def test_rows_of_null_and_repeated_ids(spark):
    """Different texts of one id, or without an id, are judged one by one."""
    word = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    near = word(1) + " more"
    rows = [(None, word(0)), (None, word(1)), (None, near), (None, near), (None, ""), (None, ""), (None, None), (5, word(2)), (5, word(3)), (5, word(3)), (6, word(3)), (None, word(2) + " x"), (7, ""), (None, TEXT), (8, TEXT), (8, word(4))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in neardup.deduplicate(docs).collect()]
    ones = [x for x in kept if x[1] in (word(1), near)]
    assert len(ones) == 1
    want = [(None, word(0)), (None, ""), (None, ""), (None, None), (5, word(2)), (5, word(3)), (7, ""), (8, TEXT), (8, word(4)), *ones]
    assert sorted(kept, key=str) == sorted(want, key=str)
    bench = spark.createDataFrame([(1, TEXT)], "item_id long, text string")
    left = [tuple(r) for r in decontaminate.remove_leaks(docs, bench).collect()]
    assert sorted(left, key=str) == sorted((x for x in rows if x[1] != TEXT), key=str)
    cut = Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring.remove_repeats(docs).collect())
    # The order of one id's texts is that of a hash, so of two documents with the same words either may be the first.
    seen, want, last = set(), Counter(), {}
    digest = {r["text"]: r["d"] for r in docs.select("text", F.xxhash64("text").alias("d")).collect()}
    for i, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, digest[x[1]])):
        w = (t or "").split()
        keys = [tuple(w[k : k + 20]) for k in range(len(w) - 19)]
        gone = {p for k, x in enumerate(keys) if x in seen and (i, t) not in seen for p in range(k, k + 20)}
        if (i, t) in seen:  # a repeated row gets what its twin got
            gone = last[(i, t)]
        else:
            seen.update([*keys, (i, t)])
        last[(i, t)] = gone
        want[(i, len(w), len(gone))] += 1
    assert cut == want


def test_lines_are_counted_by_documents(spark):
    """Copies count one by one, but lines that only few texts hold stay."""
    own = lambda i: "\n".join(f"own line {chr(97 + i % 26)} {'abcdefghij'[i // 26]} {w}" for w in "of this text alone stands here now".split())
    often = "subscribe to our letter and share this page with all of your good friends and family today please"
    copied = "\n".join(["a text that is copied as it is", "many times over in this host", "and that no other text repeats"])
    rows = [(i, own(i), "h") for i in range(12)] + [(100 + i, f"{often}\n{own(i % 12)[:15]}", "h") for i in range(60)]
    rows += [(200 + i, copied, "h") for i in range(80)] + [(300 + i, often, "other") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert all(got[i]["kept"] and not got[i]["n_removed"] for i in [*range(12), *range(200, 280), *range(300, 360)])
    assert all(got[100 + i]["n_removed"] == 18 and not got[100 + i]["kept"] for i in range(60))
