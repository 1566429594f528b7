"""The driver's contract: names, oracles on the smallest tables, plans, and life without the llm folder."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tidemark.plans import queries as base

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(base.ORACLE_SQL))
def test_oracle(spark, con, name):
    df = base.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = sorted(map(repr, con.sql(f"select {quoted} from ({base.ORACLE_SQL[name]})").fetchall()))
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["anchor_sentences", "gap_scan", "chunk_context", "glossary_index", "missing_context", "anchor_nearest_bound", "term_longer"])
def test_plan_has_no_cross_join_or_row_udf(spark, name):
    plan = base.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_columns_are_pruned(spark):
    plan = base.QUERIES["text_width"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_without_llm(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse"))
    shutil.rmtree(tmp_path / "repo/tidemark/llm", ignore_errors=True)
    (tmp_path / "repo/corpus_pipeline.py").unlink(missing_ok=True)
    code = "import __spark_entry__ as e; assert 'text_width' in e.queries() and 'pipeline' not in e.queries() and not any(k.startswith('op') for k in e.oracle_sql())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, env={**os.environ, "PYTHONPATH": str(tmp_path / "repo")})


@pytest.mark.parametrize("name,scans", [("plan_units", 2), ("sentence_split", 1), ("sentence_split_zh", 1)])
def test_sentences_are_made_once(spark, name, scans):
    """What is exploded was made twice, once for a filter on its size that Spark infers."""
    plan = base.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == scans and "Filter (" not in plan


def test_places_are_found_once(spark):
    plan = base.QUERIES["anchor_sentences"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("translate(") == 0
