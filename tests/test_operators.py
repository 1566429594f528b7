import datetime as dt
import json
import zipfile

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import anchor as an
from tidemark.operators import cues as cu
from tidemark.operators import glossary as gl
from tidemark.operators import housekeeping as hk
from tidemark.operators import timeline as tl
from tidemark.operators import words as wd
from tidemark.plans import queries as base
from tidemark.plans import views as v
from tidemark.sources import external as ex
from tidemark.sources import plans as pl
from tidemark.sources import sinks
from tidemark.sources import subtitles as sub
from tidemark.streaming.gaps import gap_sessions, windowed_counts
from tests.conftest import SMALL

CUES = "doc_id long, idx long, start_ms long, end_ms long, text string"


def cues(spark, *rows):
    return spark.createDataFrame([(1, i, s, e, t) for i, s, e, t in rows], CUES)


def test_marker_inside_gap_stays_earlier(spark):
    c = cues(spark, (1, 0, 1000, "hi"), (2, 3000, 4000, "[x]"), (3, 7001, 8000, "yo"), (4, 13000, 14000, "at"))
    assert [(r["ia"], r["ib"], r["gap_ms"]) for r in cu.speech_gaps(c).collect()] == [(1, 3, 6001)]  # 5000 exactly is no gap
    assert {r["idx"]: r["group_id"] for r in cu.gap_groups(c).collect()} == {1: 0, 2: 0, 3: 1, 4: 1}


def test_chunks_and_context(spark):
    c = cues(spark, *[(i, i * 100, i * 100 + 50, f"t{i}") for i in range(1, 8)])
    rows = cu.chunk(c, owned=3, ctx=2).collect()
    of = lambda k, role: sorted(r["idx"] for r in rows if r["chunk_no"] == k and r["role"] == role)
    assert of(2, "before") == [2, 3] and of(2, "owned") == [4, 5, 6] and of(2, "after") == [7]
    assert cu.merge_owned(cu.chunk(c, 3, 2)).exceptAll(c).count() == 0


def test_srt_round_trip_and_options(spark):
    text = "﻿1\r\n00:00:01,000 --> 00:00:02,000\r\n[Music]\r\n\r\n2\n00:00:03,000 --> 00:00:04,500\nhello\nworld [cheers]\n \n3\nbad\nx"
    files = spark.createDataFrame([(1, text.replace("﻿", ""))], "doc_id long, value string")
    assert [(r["idx"], r["start_ms"], r["text"]) for r in sub.parse_srt(files).collect()] == [(2, 3000, "hello world")]
    assert sub.parse_srt(files, markers="keep").count() == 2
    assert sub.parse_srt(files, markers="blank").filter("text = ''").count() == 1
    assert sub.parse_srt(files, markers="keep", body="array").filter(F.size("body") == 2).count() == 1
    assert [(r["idx"], r["end_ms"]) for r in sub.parse_lines(files).orderBy("idx").collect()] == [(1, 2000), (2, 4500)]
    c = v.cues(spark, SMALL)
    again = sub.parse_srt(sub.render_srt(c, renumber=False), markers="keep")
    assert again.select("doc_id", "idx", "start_ms", "end_ms").exceptAll(c.select("doc_id", "idx", "start_ms", "end_ms")).count() == 0


def test_segments_and_chunk_files(spark, tmp_path):
    f = spark.createDataFrame([(1, "1|c1-c2~|a\n2|c2~|b|c\nnoise")], "doc_id long, value string")
    assert [tuple(r)[1:] for r in sub.parse_segments(f).collect()] == [(1, 1, False, 2, True, "a"), (2, 2, True, 2, True, "b|c")]
    c = cues(spark, *[(i, i * 100, i * 100 + 50, f"t{i}") for i in range(1, 5)])
    files = sub.render_chunks(cu.chunk(c, 2, 1)).select(F.format_string("chunk_%03d", "chunk_no").alias("doc_id"), "value")
    rows = sub.parse_chunks(files).collect()
    assert sorted((r["chunk_no"], r["role"], r["idx"]) for r in rows) == [(1, "after", 3), (1, "owned", 1), (1, "owned", 2), (2, "before", 2), (2, "owned", 3), (2, "owned", 4)]
    (tmp_path / "chunk_001.txt").write_text("## OWNED\nc1\tx", encoding="utf-8")
    assert sub.parse_chunks(sub.read_files(spark, str(tmp_path))).count() == 1


def test_plan_files(spark):
    text = "# head\n## S1\n- EN: One two\n- ZH: 一二\n- 关系: 1:n\n### S1a\n- EN: One\n- ZH: 一\n### S1b\n- EN: two\n- ZH: 二\n## S2+3\n- EN: Three\n- ZH: 三"
    rows = pl.parse_plan(spark.createDataFrame([(1, text)], "doc_id long, value string")).orderBy("seq").collect()
    assert [r["numbers"] for r in rows] == [[1], [2, 3]] and rows[0]["problem"] is None and rows[1]["problem"] == "no relation"
    assert [u["en"] for u in rows[0]["units"]] == ["One", "two"] and rows[1]["units"][0]["en"] == "Three"
    plans = spark.createDataFrame([(1, 1, 1, [3], "A"), (1, 2, 1, [1, 2], "B"), (1, 2, 2, [2], "a")], "doc_id long, chunk_no int, seq int, numbers array<int>, en string")
    assert sorted(tuple(r["numbers"]) for r in pl.join_plans(plans).collect()) == [(3,), (4, 5)]
    m = pl.parse_matches(spark.createDataFrame([(1, "Z5+Z6 = E5\n# c\noops")], "doc_id long, value string")).orderBy("line_no").collect()
    assert (m[0]["z"], m[0]["e"], m[1]["problem"]) == ([5, 6], [5], "oops")
    t = pl.parse_table(spark.createDataFrame([(1, "x\n| EN | note | ZH |\n|---|---|---|\n| a | n | b |\ny")], "doc_id long, value string"), {"en": ["en"], "zh": ["译名", "zh"]}).collect()
    assert [(r["line"], r["en"], r["zh"]) for r in t] == [(4, "a", "b")]
    n = pl.parse_numbered(spark.createDataFrame([(1, "# t\n- E1: ab\ncd\n- E2: x")], "doc_id long, value string")).orderBy("n").collect()
    assert [r["text"] for r in n] == ["abcd", "x"]
    fm = pl.parse_front_matter(spark.createDataFrame([(1, "---\ntitle: A: b\n---\nbody"), (2, "none")], "doc_id long, value string")).orderBy("doc_id").collect()
    assert fm[0]["meta"]["title"] == "A: b" and fm[0]["body"] == "body" and fm[1]["meta"] is None
    s = pl.parse_section(spark.createDataFrame([(1, "# A\nx\n# B\ny")], "doc_id long, value string"), "B").collect()
    assert [r["line"] for r in s] == ["y"]


def test_glossary(spark):
    g = spark.createDataFrame([("L2", "p2", 2, 1, "Water Column; BE", "T", "水柱2"), ("L1", "p1", 1, 1, "water column (aka wc1)", None, "水柱"), ("L1", "p1", 1, 2, "column", "B3", "柱")], "level string, path string, source_order int, row_no long, term_en string, short_form string, term_zh string")
    ix = gl.build_index(g)
    got = {r["term_key"]: (r["level"], r["zh"]) for r in ix.collect()}
    assert got == {"water column": ("L1", "水柱"), "wc1": ("L1", "水柱"), "column": ("L1", "柱"), "b3": ("L1", "柱"), "be": ("L2", "水柱2")}
    rows = spark.createDataFrame([(1, "A Water Column, B3 not B36."), (2, "columns"), (3, None)], "id int, text string")
    for scan in (gl.scan, gl.scan_grams):
        assert sorted((r["id"], r["term_key"]) for r in scan(rows, ix, ["id"]).collect()) == [(1, "b3"), (1, "water column")]
    assert [r["row_no"] for r in gl.query(g, "COLUMN").collect()] == [1, 2, 1]
    assert gl.build_index(g, levels=["L2"]).filter("level <> 'L2'").count() == 0
    terms = spark.createDataFrame([(1, "column", "柱"), (2, "water column", "水柱"), (3, "gone", "x")], "line long, en string, zh string")
    assert [tuple(r) for r in gl.longer_terms(terms).collect()] == [(1, 2)]
    src = spark.createDataFrame([(1, 1, "a water column"), (1, 2, "one column")], "doc_id long, chunk_no long, text string")
    tgt = spark.createDataFrame([(1, 1, "一个水 柱"), (1, 2, "没有")], "doc_id long, chunk_no long, text string")
    st = {(r["line"], r["chunk_no"]): r["status"] for r in gl.check_terms(terms, src, tgt).collect()}
    assert st == {(1, 1): "covered", (1, 2): "miss", (2, 1): "hit", (3, None): "absent"}
    std = gl.standard_columns(spark.createDataFrame([("e", "z")], "English string, Chinese string"), "L1", "p", 0).first()
    assert (std["term_en"], std["term_zh"], std["short_form"]) == ("e", "z", None)


def test_large_dictionaries_scan_alike(spark, monkeypatch):
    """One boundary and one rule for punctuation at every size of the dictionary, on mixed scripts."""
    terms = ["steel", "iron ingot", "iron-ingot", "c++", "c", "水柱", "水", "++", "café", "éclair", "wc1", "柱 b", "a.b", "ingot of iron", "iron", "σοφος", "end$", "№", "don't"]
    index = spark.createDataFrame([(t, "L1", "p", t) for t in terms], "term_key string, level string, path string, zh string")
    texts = ["使用steel材料", "STEELworks, steel-works", "iron-ingot and Iron Ingot", "iron  ingot", "C++ is not c", "objc++", "高水柱低", "a水b", "x ++ y", "CAFÉ-Éclair", "xéclair", "WC12 wc1", "柱 B, 柱 bb", "axb a.b", "ingot of iron ingot", "ΣΟΦΟΣ", "end$1 end$", "№5 №", "don't don’t", "", None, "𝒳steel𝒳", "ſteel \u212a", "a\nsteel\n水"]
    rows = spark.createDataFrame([(i if i % 3 else None, t) for i, t in enumerate(texts + texts[:4])], "id int, text string")
    small = [tuple(r) for r in gl.scan(rows, index, ["id"]).select("id", "term_key", "zh").collect()]
    monkeypatch.setattr(gl, "PATTERN_TERMS", 5)
    large = [tuple(r) for r in gl.scan(rows, index, ["id"]).select("id", "term_key", "zh").collect()]
    assert sorted(large, key=str) == sorted(small, key=str)
    hits = {t for _, t, _ in small}
    assert {"steel", "iron-ingot", "c++", "水柱", "++", "a.b"} <= hits and (None, "steel", "steel") in large


def test_anchor_and_shared_cue(spark):
    c = cues(spark, (1, 0, 1000, "One two. Thr"), (2, 1000, 2000, "ee four."), (3, 9000, 9500, "One two."))
    s = spark.createDataFrame([(1, 1, "One two."), (1, 2, "Three four."), (1, 3, "Nowhere."), (1, 4, "...")], "doc_id long, seq long, sentence string")
    off = an.cue_offsets(c)
    held = an.on_cues(an.locate(c, s), off)
    got = {r["seq"]: (r["status"], r["cue_first"], r["cue_last"]) for r in held.collect()}
    assert got == {1: ("non-unique", 1, 1), 2: ("unique", 1, 2), 3: ("failed", None, None), 4: ("failed", None, None)}
    r = {x["seq"]: (x["start"], x["end"]) for x in an.resolve_shared(an.timed(held, c), c, off).collect()}
    assert r[1] == (0, 666) and r[2] == (666, 2000) and r[3] == (2000, 2000)
    near = an.nearest_bound(spark.createDataFrame([(1, 1, 150.0), (1, 2, 5000.0)], "doc_id long, key long, at double"), spark.createDataFrame([(1, 100), (1, 200)], "doc_id long, t long"))
    assert {x["key"]: x["bound"] for x in near.collect()} == {1: 100, 2: None}


def test_reflow_is_monotone(spark):
    from tidemark.plans.queries import _story

    c, s, u = _story(spark, SMALL)
    t = tl.reflow(c, s, u)
    assert t.count() == u.count()
    from pyspark.sql import Window as W

    w = W.partitionBy("doc_id", "seq").orderBy("unit_no")
    assert t.withColumn("p", F.lag("end").over(w)).filter("start < p and alloc = 'cue'").count() == 0


def test_breaks(spark):
    c = cues(spark, (1, 0, 1, "one two"), (2, 9000, 9001, "three"), (3, 20000, 20001, "four"))
    t = spark.createDataFrame([(1, "One two. Three four.")], "doc_id long, text string")
    got = {(r["ia"], r["ib"]): r["status"] for r in an.check_breaks(c, t, cu.speech_gaps(c)).collect()}
    assert got == {(1, 2): "pass", (2, 3): "violate"}


def test_words_and_merges(spark):
    p = spark.createDataFrame([(1, "g", 1, "a", 1), (1, "g", 3, "c", 2), (1, "g", 1, "z", 3), (2, "h", 1, "甲", 1), (2, "h", 2, "乙", 2)], "doc_id long, gid string, part long, text string, seq long")
    got = {r["doc_id"]: (r["text"], r["missing"], r["repeated"]) for r in wd.merge_parts(p).collect()}
    assert got == {1: ("a c", "2", 1), 2: ("甲乙", "", 0)}
    t = spark.createDataFrame([(1, "Aa bb. " * 30), (2, "x" * 50)], "doc_id long, text string")
    parts = wd.chunk_text(t, unit="paragraph", max_chars=40).collect()
    assert all(len(r["piece"]) <= 41 for r in parts) and "".join(r["piece"] for r in sorted(parts, key=lambda r: r["part"]) if r["doc_id"] == 2) == "x" * 50


def test_checks_of_plans(spark):
    s = spark.createDataFrame([(1, 1, "One two", "一二"), (1, 2, "x", "甲")], "doc_id long, seq long, en string, zh string")
    u = spark.createDataFrame([(1, 1, 1, "One", "一"), (1, 1, 2, "two", "二"), (1, 2, 1, "y", "甲（【承接句】")], "doc_id long, seq long, unit_no long, en string, zh string")
    assert sorted((r["seq"], r["rule"]) for r in tl.check_plan(s, u).collect()) == [(2, "bracket"), (2, "en-concat"), (2, "residue"), (2, "zh-concat")]


def test_sinks_and_connectors(spark, tmp_path):
    g = spark.createDataFrame([("a", "x; y/z"), ("b", None)], "term string, category string")
    sinks.write_categories(g, str(tmp_path / "cats"))
    assert sorted(r["category"] for r in spark.read.option("header", True).csv(str(tmp_path / "cats")).collect()) == ["uncategorized", "x", "y_z"]
    c = v.cues(spark, SMALL)
    sinks.write_srt(c, str(tmp_path / "srt"))
    sinks.write_jsonl(c, str(tmp_path / "json"))
    sinks.write_chunks(cu.chunk(c, 3, 1), str(tmp_path / "chunks"))
    sinks.write_languages(spark.createDataFrame([("c", "k", "e", "")], "category string, key string, en string, de string"), str(tmp_path / "lang"))
    assert spark.read.json(str(tmp_path / "json")).count() == c.count()
    with zipfile.ZipFile(tmp_path / "a.jar", "w") as z:
        z.writestr("lang/en.json", json.dumps({"block.x": "X", "item.y": "Y"}))
    texts = ex.archive_members(spark, str(tmp_path / "a.jar"), r"lang/.*\.json").withColumn("lang", F.lit("en"))
    entries = ex.language_entries(texts)
    assert sorted((r["category"], r["key"]) for r in gl.classify_keys(entries, {"b": [r"block\..*"], "all": [".*"]}).collect()) == [("all", "block.x"), ("all", "item.y"), ("b", "block.x")]
    m = spark.createDataFrame([('{"latest":{"release":"2"},"versions":[{"id":"1","url":"u1"},{"id":"2","url":"u2"}]}',)], "value string")
    assert ex.latest_release(m).first()["url"] == "u2"
    a = spark.createDataFrame([('{"objects":{"p/a":{"hash":"h","size":3},"q":{"hash":"i","size":4}}}',)], "value string")
    assert [tuple(r) for r in ex.asset_entries(a, prefix="p/").collect()] == [("p/a", "h", 3)]
    pages, lost = ex.fetch_pages(["A", "B"], lambda ts: {"query": {"redirects": [{"from": "A", "to": "C"}], "pages": [{"title": "C", "text": "t"}, {"title": "B", "missing": True}]}})
    assert pages == {"C": "t"} and lost == ["B"]
    f = tmp_path / "x.bin"
    f.write_bytes(b"x")
    assert ex.download(f.as_uri()) == b"x"
    assert ex.load_budget(None)["max_output"] == 8192
    assert ex.file_ages(spark, str(f)).count() == 1
    rows = spark.createDataFrame([("r", "at abcdef1234567 x")], "doc_id string, value string")
    assert ex.recorded_commits(rows).first()["recorded_commit"] == "abcdef1234567"
    assert sinks.gap_markdown(cu.gap_report(c)).count() == cu.speech_gaps(c).count()


def test_housekeeping(spark):
    cur = spark.createDataFrame([("a", "abc1"), ("b", "x"), ("c", None), ("d", "q")], "repo string, current_commit string")
    rec = spark.createDataFrame([("a", "abc"), ("d", "z")], "repo string, recorded_commit string")
    assert {r["repo"]: r["state"] for r in hk.staleness(cur, rec).collect()} == {"a": "ok", "b": "no index", "c": "no commit", "d": "stale"}
    hits = spark.createDataFrame([(1, 1, "k", "z")], "doc_id long, idx long, term_key string, zh string")
    p = hk.prompts(cu.chunk(cues(spark, (1, 0, 1, "a"), (2, 2, 3, "b")), 1, 0), hits, "{prev}|{text}|{next}|{terms}").orderBy("chunk_no").collect()
    assert [r["prompt"] for r in p] == ["|a|b|k = z", "a|b||none"]


def test_streaming_matches_batch(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(1, i, s, e, t, base + dt.timedelta(milliseconds=s)) for i, s, e, t in [(1, 0, 1000, "a"), (2, 6000, 7000, "b"), (3, 12001, 13000, "c"), (4, 400000, 400500, "d")]]
    df = spark.createDataFrame(rows, CUES + ", ts timestamp")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = gap_sessions(stream).writeStream.format("memory").queryName("gaps_out").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = sorted((r["first_ms"], r["cues"]) for r in spark.sql("select * from gaps_out").collect())
    want = sorted((r["f"], r["n"]) for r in cu.gap_groups(df).groupBy("group_id").agg(F.min("start_ms").alias("f"), F.count("*").alias("n")).collect())
    assert got == want == [(0, 2), (12001, 1), (400000, 1)]
    e = spark.createDataFrame([(base, "x"), (base, "x")], "ts timestamp, event_type string")
    assert windowed_counts(e).first()["n"] == 2


def test_remaining_readers_and_checks(spark):
    from tidemark.operators import checks as ck

    f = lambda t: spark.createDataFrame([(1, t)], "doc_id long, value string")
    t = pl.parse_template(f("## S?_Z1\n- EN: <x>\n- ZH: 一二\n### S?_Z1a\n- ZH: 一\n### S?_Z1b\n- ZH: 二\n## S?_Z2\n- ZH: 三")).orderBy("z").collect()
    assert [(r["z"], r["text"], r["parts"]) for r in t] == [(1, "一二", ["一", "二"]), (2, "三", ["三"])]
    assert [tuple(r)[1:] for r in pl.parse_gap_report(f("## 1. c3 → c4 （6.5s）\nx")).collect()] == [(3, 4, 6500)]
    kinds = spark.createDataFrame([(1, "1\n00:00:01,000 --> 00:00:02,000\nx"), (2, "1|c1|x"), (3, "y")], "doc_id long, value string")
    assert {r["doc_id"]: r["kind"] for r in pl.kind_of(kinds).collect()} == {1: "srt", 2: "segments", 3: "text"}
    assert pl.positional_terms(spark.createDataFrame([tuple("abcdefgh")], list("stuvwxyz"))).first() == ("c", "h")
    src = spark.createDataFrame([(1, 1, "a b c"), (1, 2, "a b"), (1, 3, "a")], "doc_id long, chunk_no long, text string")
    out = spark.createDataFrame([(1, 1, "a b 【承接句】c."), (1, 2, "a x")], "doc_id long, chunk_no long, text string")
    assert {r["chunk_no"]: (r["status"], r["instead"]) for r in ck.wording(src, out).collect()} == {1: ("subset", None), 2: ("differs", "x"), 3: ("missing", None)}
    assert ck.ends(spark.createDataFrame([([1, 2, 3, 4],)], "a array<int>"), "a", 2).first()["tail"] == [3, 4]
    assert ck.summary(ck.wording(src, out)).count() == 3


@settings(max_examples=300, deadline=None)
@given(st.text("ab'é", max_size=120), st.lists(st.one_of(st.none(), st.text("ab'é", max_size=30), st.tuples(st.integers(0, 90), st.integers(0, 60))), max_size=8))
def test_places_of_strings(text, wanted):
    wanted = [text[w[0] : w[0] + w[1]] if isinstance(w, tuple) else w for w in wanted]
    want = [(-1, -1) if not w else (first := text.find(w), text.find(w, first + 1) if first >= 0 else -1) for w in wanted]
    assert an.places(text, wanted) == want


def test_prompts_carry_terms(spark):
    rows = base.QUERIES["prompt_render"](spark, SMALL).collect()
    assert any("Terms: none" not in r["prompt"] for r in rows)


def test_check_terms_finds_all_that_its_patterns_do(spark):
    """Candidates by tokens lose none of the pairs that a comparison of all chunks with all terms locates."""
    from tidemark.functions import text as tx

    names = ["bus", "water bus", "C++", "iron-ingot", "WaterColumn", "水柱", "µm", "№ 5", "of", "café", "don't", "B-3", "++", "a/b", "3", "straße", "STEEL", "\u2010", "éclair"]
    texts = ["two buses of iron ingot", "Water-Bus C++ cafés", "the waterbus; a watercolumn", "一个水柱 steel", "5 Μm and μm, № 5!", "DON'T b3 B 3", "x++y a b", None, "", "ſteel STRASSE straße", "w a t e r c o l u m n", "13 33 3", "ÉCLAIRS caféb", "iron\u2010ingots", "s teelſ"]
    terms = spark.createDataFrame([(i, n, "z") for i, n in enumerate(names)], "line long, en string, zh string")
    src = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)] + [(2, 0, texts[0])], "doc_id long, chunk_no long, text string")
    got = {(r["line"], r["doc_id"], r["chunk_no"]) for r in gl.check_terms(terms, src, src).collect() if r["status"] != "absent"}
    forms = terms.select("line", F.explode(tx.term_forms(F.col("en"))).alias("form")).select("line", "form", tx.word_pattern(F.col("form")).alias("p"), tx.compact_pattern(F.col("form")).alias("q"), tx.compact(F.col("form")).alias("c"))
    both = src.withColumn("compact", tx.compact(F.col("text"))).crossJoin(forms).filter("text rlike p or (not form rlike '[ -]' and c <> '' and compact rlike q)")
    want = {(r["line"], r["doc_id"], r["chunk_no"]) for r in both.collect()}
    assert got == want and len(want) > 15
    plan = gl.check_terms(terms, src, src)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_equal_places_stay_rows(spark):
    places = spark.createDataFrame([(1, 1, 0, 3), (1, 1, 0, 3), (1, 2, None, None), (2, 1, 5, 6)], "doc_id long, seq long, pos long, pos_end long")
    offsets = spark.createDataFrame([(1, 1, 0, 2), (1, 2, 2, 2), (1, 3, 2, 9)], "doc_id long, idx long, off_start long, off_end long")
    rows = sorted(map(tuple, an.on_cues(places, offsets).collect()), key=repr)
    assert rows == [(1, 1, 0, 3, 1, 3), (1, 1, 0, 3, 1, 3), (1, 2, None, None, None, None), (2, 1, 5, 6, None, None)]


def test_breaks_count_all_kept_characters(spark):
    """The marked text had no place for a letter whose lower case is two characters, and places after it were off by one."""
    assert an.breaks([(1, "aib"), (2, "c")], "aİ b. c", [(1, 2), (2, 3)]) == ["pass", "skip"]
    c = spark.createDataFrame([(1, 1, "aİ b."), (1, 2, "c"), (2, 1, "x"), (2, 2, "y")], "doc_id long, idx long, text string")
    t = spark.createDataFrame([(1, "aİ b. c"), (2, "x, y.")], "doc_id long, text string")
    got = an.check_breaks(c, t, c.select("doc_id", F.col("idx").alias("ia"), (F.col("idx") + 1).alias("ib"))).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 2, "pass"), (1, 2, 3, "skip"), (2, 1, 2, "violate"), (2, 2, 3, "skip")]


def test_bag_diff_shuffles_only_what_differs(spark):
    rows = spark.createDataFrame([(1, ["x", "y", "y"], ["y"]), (1, ["z"], ["z", "w"]), (1, ["w"], []), (2, None, ["q"]), (3, [], []), (4, [None, "a"], ["a"])], "k long, a array<string>, b array<string>")
    out = wd.bag_diff(rows, ["k"], "a", "b", "item")
    assert sorted(map(tuple, out.collect()), key=repr) == [(1, "x", 1, 0), (1, "y", 1, 0), (2, "q", 0, 1), (4, None, 1, 0)]
    plan = base.QUERIES["multiset_diff"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and plan.count("ArrowEvalPython") == 1
