"""Connectors beyond plain tables: archives, JSON manifests, verified downloads, file ages, commits, options.

What touches the network or the driver's disk is an interface with a local implementation; rows come out as
DataFrames.
"""

from __future__ import annotations

import hashlib
import io
import json
import subprocess
import urllib.request
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Defaults of the context budget.
BUDGET = {"context_length": 1_000_000, "max_output": 8192, "split_ratio": 0.05, "output_ratio": 0.8, "amplification": 5.0}


def archive_members(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(path, member, text) of zip or jar members whose name matches ``pattern``."""
    import re

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = re.compile(pattern)
        for pdf in batches:
            out = []
            for name, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    out += [(name, m, z.read(m).decode("utf-8", "replace")) for m in z.namelist() if wanted.search(m)]
            yield pd.DataFrame(out, columns=["path", "member", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, member string, text string")


def language_entries(texts: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, key, text) of JSON language maps."""
    parsed = F.from_json(F.col(text), "map<string,string>")
    return texts.select(F.col(lang).alias("lang"), F.explode(parsed).alias("key", "text"))


def latest_release(manifests: DataFrame, text: str = "value") -> DataFrame:
    """The latest release's id and address of version manifests."""
    schema = "latest struct<release:string>, versions array<struct<id:string,type:string,url:string>>"
    m = manifests.select("*", F.from_json(F.col(text), schema).alias("m"))
    hit = F.element_at(F.filter("m.versions", lambda v: v["id"] == F.col("m.latest.release")), 1)
    return m.select(F.col("m.latest.release").alias("release"), hit["url"].alias("url"))


def asset_entries(indexes: DataFrame, text: str = "value", prefix: str = "") -> DataFrame:
    """(name, hash, size) of an asset index's objects under a prefix."""
    objects = F.from_json(F.col(text), "objects map<string,struct<hash:string,size:bigint>>")["objects"]
    rows = indexes.select(F.explode(objects).alias("name", "o")).filter(F.startswith("name", F.lit(prefix)))
    return rows.select("name", "o.hash", "o.size")


def download(url: str, sha1: str | None = None, tries: int = 3, opener: Callable = urllib.request.urlopen) -> bytes:
    """Bytes of an address, checked against a SHA-1 and tried again if they differ."""
    error: Exception | None = None
    for _ in range(tries):
        try:
            with opener(url) as r:
                data = r.read()
            if sha1 and hashlib.sha1(data).hexdigest() != sha1:
                raise ValueError(f"SHA-1 of {url} differs")
            return data
        except (OSError, ValueError) as e:
            error = e
    raise error  # type: ignore[misc]


def fetch_pages(titles: list[str], get: Callable[[list[str]], dict], batch: int = 10) -> tuple[dict[str, str], list[str]]:
    """Texts of wiki pages, ``batch`` titles a call, following redirects; and the titles that none covers."""
    pages: dict[str, str] = {}
    covered: set[str] = set()
    for i in range(0, len(titles), batch):
        q = get(titles[i : i + batch]).get("query", {})
        moved = {r["to"]: r["from"] for k in ("normalized", "redirects") for r in q.get(k, [])}
        for p in q.get("pages", []):
            if "missing" in p:
                continue
            pages[p["title"]] = p.get("text", "")
            name = p["title"]
            while name is not None and name not in covered:
                covered.add(name)
                name = moved.get(name)
    return pages, [t for t in titles if t not in covered]


def file_ages(spark: SparkSession, path: str) -> DataFrame:
    """(path, modified) of files, by listing only."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("modificationTime").alias("modified"))


def load_budget(path: str | None) -> dict[str, float]:
    """Budget options of a JSON file; a missing file or a value that is no positive number gives the default."""
    try:
        given = json.loads(Path(path).read_text(encoding="utf-8")) if path else {}
    except (OSError, ValueError):
        given = {}
    good = lambda v: isinstance(v, (int, float)) and not isinstance(v, bool) and v > 0
    return {k: given[k] if isinstance(given, dict) and good(given.get(k)) else d for k, d in BUDGET.items()}


def head_commits(spark: SparkSession, repositories: dict[str, str]) -> DataFrame:
    """(repo, current_commit) of local repositories; null where there is none."""
    rows = []
    for name, path in repositories.items():
        done = subprocess.run(["git", "-C", path, "rev-parse", "HEAD"], capture_output=True, text=True)
        rows.append((name, done.stdout.strip() or None if done.returncode == 0 else None))
    return spark.createDataFrame(rows, "repo string, current_commit string")


def recorded_commits(files: DataFrame) -> DataFrame:
    """(repo, recorded_commit) of index files: the first commit id in their text."""
    return files.select(F.col("doc_id").alias("repo"), F.nullif(F.regexp_extract("value", r"\b([0-9a-f]{7,40})\b", 1), F.lit("")).alias("recorded_commit"))
