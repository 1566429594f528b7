"""WARC archives: writing captures and assembling them again.

A capture is a transaction of three records: a request, a response (or a revisit, which refers to the response
with the same payload and holds none), and a metadata record. Request and metadata name their response in
WARC-Concurrent-To. Reading parses the archives record by record, by Content-Length, and joins the records of
one transaction through those identifiers into one nested row.

Archives are written by Spark itself, as gzip text whose line separator is the record's end (two CRLF), so any
file system that Spark writes to will do. Captures are written by classes of payload size, fewer to an archive the
larger they are (``CLASSES``), so archives stay of a bounded size and can be read back as binary files.

Defined results: a null html is an empty payload; a null url gives records without a target; every row, equal rows
too, gives a transaction of its own; a null page_id counts as smaller than any other, and equal payloads without any id
are all responses; empty tables give no archives and an empty result; further columns are ignored. Payloads may hold any
text, also what looks like a record. On reading, a record without a whole Content-Length is passed over, a record without
an id gets one from its bytes, and of a cut or corrupt archive all that can be read is.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.runtime import drop, fresh, remove, table

#: Payload bytes from which equal payloads become revisits.
REVISIT_FROM = 1000
#: Payload bytes from which a class begins, and captures in one of its archives: 128 MiB of payloads, or one payload.
CLASSES = [(0, 2048), (1 << 16, 128), (1 << 20, 8), (1 << 24, 1)]
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _urn(*parts) -> F.Column:
    x = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(x, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _record(kind: F.Column | str, urn: F.Column, body: F.Column, mime: str, *headers: tuple[str, F.Column]) -> F.Column:
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind if isinstance(kind, F.Column) else F.lit(kind)), F.concat(F.lit("WARC-Record-ID: "), urn), F.lit(f"WARC-Date: {DATE}")]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]  # null: no such line
    lines += [F.lit(f"Content-Type: {mime}"), F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), body)


def write_warc(pages: DataFrame, path: str, revisit_from: int = REVISIT_FROM) -> None:
    """Write request, response or revisit, and metadata records of (page_id, url, html) rows under ``path``.

    Of captures with equal payloads of at least ``revisit_from`` bytes, the one with the largest page_id is the
    response and the others revisit it.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.regexp_replace("url", r"[\r\n]", " ").alias("url"), html.alias("html"), F.sha1(html).alias("digest"), F.octet_length(html).alias("bytes"))
    # Digests alone are grouped and joined; of the html, only what belongs to repeated payloads' rows needs a lookup.
    digests = table(rows.filter(F.col("bytes") >= revisit_from).select("page_id", "digest", "bytes"), "warc-digests")
    most = digests.agg(F.max("bytes")).first()[0] or 0
    heads = digests.groupBy("digest", "page_id").agg(F.count(F.lit(1)).alias("n")).groupBy("digest").agg(F.max(F.struct("page_id", "n")).alias("x"), F.sum("n").alias("all"))
    heads = heads.filter(F.col("all") > 1).select("digest", F.col("x.page_id").alias("head"), (F.col("x.n") == 1).alias("single")).filter("head is not null")
    repeated = digests.join(heads, "digest").select("page_id", "digest", "head", "single").distinct()

    def told(rows: DataFrame) -> DataFrame:
        known = rows.join(repeated, rows["page_id"].eqNullSafe(repeated["page_id"]) & (rows["digest"] == repeated["digest"]), "left").select(rows["*"], "head", "single")
        known = known.withColumn("again", F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head")))
        return known.withColumns({x: F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")) for x in ("own", "own_request", "own_metadata")})

    # What others refer to has an id that they can tell: the one response of a payload, if it is only one.
    named = F.when(F.col("single"), _urn(F.lit("response"), F.col("head").cast("string"), F.col("digest")))
    own = F.when(~F.col("again"), F.coalesce(named, "own")).otherwise(F.col("own"))
    target = ("WARC-Target-URI", F.col("url"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    response = F.when(~F.col("again"), _record("response", own, F.concat(http, "html"), "application/http; msgtype=response", target, digest)).otherwise(
        _record("revisit", own, http, "application/http; msgtype=response", target, digest, ("WARC-Refers-To", named), ("WARC-Profile", F.lit(PROFILE)))
    )
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"://([^/?#]*)", 1)
    ask = F.concat(F.lit("GET "), F.coalesce(F.nullif("url", F.lit("")), F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END))
    request = _record("request", F.col("own_request"), ask, "application/http; msgtype=request", target, ("WARC-Concurrent-To", own))
    notes = F.concat_ws("\r\n", F.concat(F.lit("pageId: "), F.col("page_id").cast("string")), F.lit("via: crawl"))
    metadata = _record("metadata", F.col("own_metadata"), notes, "application/warc-fields", target, ("WARC-Concurrent-To", own))
    for (least, captures), (above, _) in zip(CLASSES, [*CLASSES[1:], (None, None)]):
        if least <= most:
            some = told(rows.filter((F.col("bytes") >= least) & (F.col("bytes") < above if above else F.lit(True))))
            records = some.select(F.explode(F.array(request, response, metadata)).alias("value"))
            records.write.mode("append").option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", 3 * captures).text(path)
    drop(digests)


RECORD = "record_id string, type string, target string, concurrent_to array<string>, refers_to string, payload_digest string, date string, headers map<string,string>, content string, payload_bytes long, payload_sha1 string"


_BEGIN = re.compile(rb"(?:\A|(?<=\n))WARC/\d+\.\d+\r?\n")
_LENGTH = re.compile("[0-9]{1,18}")
_MAGIC, _CHUNK = b"\x1f\x8b\x08", 1 << 14


def parse_records(data: bytes) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Headers (lower-case names, all values of each) and block of every record of an uncompressed archive. A cut last
    record is given as far as it goes; after headers without a whole Content-Length the next record is looked for."""
    at = 0
    while begin := _BEGIN.search(data, at):
        end = data.find(b"\r\n\r\n", begin.start())
        if end < 0:
            return
        headers: dict[str, list[str]] = {}
        values: list[str] = []
        for line in data[begin.end() : end].decode("utf-8", "replace").split("\r\n"):
            if line[:1] in (" ", "\t") and values:
                values[-1] += " " + line.strip()  # a folded line
            else:
                name, _, value = line.partition(":")
                values = headers.setdefault(name.strip().lower(), [])
                values.append(value.strip())
        length = headers.get("content-length", [""])[0]
        at = end + 4
        if _LENGTH.fullmatch(length):
            yield headers, data[at : at + int(length)]
            at += int(length)


def _inflate(data: bytes) -> bytes:
    """An archive's bytes. Of gzip members each is read as far as it goes; after a broken one the next is looked for."""
    if not data.startswith(_MAGIC[:2]):
        return data
    out, at, view = [], 0, memoryview(data)
    while 0 <= at < len(data):
        member, here = zlib.decompressobj(31), at
        try:
            while not member.eof and here < len(data):
                out.append(member.decompress(view[here : here + _CHUNK]))
                here += _CHUNK
        except zlib.error:
            at = data.find(_MAGIC, at + 1)
            out.append(b"\r\n")  # a record may begin here
            continue
        at = data.find(_MAGIC, min(here, len(data)) - len(member.unused_data))
    return b"".join(out)


def _row(headers: dict[str, list[str]], block: bytes, content: bool) -> tuple:
    first = lambda name: next(iter(headers.get(name, ())), None)
    kind = first("warc-type")
    payload = block.partition(b"\r\n\r\n")[2] if (first("content-type") or "").startswith("application/http") else block
    own = first("warc-record-id") or f"<urn:sha1:{hashlib.sha1(repr(sorted(headers.items())).encode() + block).hexdigest()}>"
    text = payload.decode("utf-8", "replace") if content or kind != "response" else None
    digest = (first("warc-payload-digest") or "").removeprefix("sha1:") or None
    flat = [(k, ", ".join(v)) for k, v in headers.items()]
    return own, kind, first("warc-target-uri"), headers.get("warc-concurrent-to", []), first("warc-refers-to"), digest, first("warc-date"), flat, text, len(payload), hashlib.sha1(payload).hexdigest()


def _parse(content: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("content"):
                rows, held = [], 0
                for headers, block in parse_records(_inflate(blob.as_py())):
                    rows.append(_row(headers, block, content))
                    held += len(block)
                    if len(rows) == 500 or held > 16 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return run


_ARROW = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("target", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("date", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("content", pa.string()), ("payload_bytes", pa.int64()), ("payload_sha1", pa.string())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def read_warc(spark: SparkSession, path: str, content: bool = True) -> DataFrame:
    """One row for each record of the archives under ``path`` (gzip, by member or whole, or plain). Without
    ``content`` response payloads are measured and hashed but not kept."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_parse(content), RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row for each capture: its request, response (or revisit) and metadata records, and how many records it
    has, joined through all identifiers that they are concurrent to, over any number of steps. Of several records of a
    kind the one of the greatest id stands in the row. Parts whose main record is missing form a capture with a null
    response. ``capture_id``: the response's id, or what the parts name."""
    records = table(records, "warc-records")
    links = records.select(F.col("record_id").alias("u"), F.explode("concurrent_to").alias("v")).filter("u <> v")
    ends = links.select(F.col("u").alias("x"), F.lit(1).alias("gives"), F.lit(0).alias("takes")).union(links.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("x").agg(F.sum("gives").alias("gives"), F.sum("takes").alias("takes"))
    main = F.coalesce(F.get("concurrent_to", F.lit(0)), "record_id")
    if ends.filter("gives > 1 or gives > 0 and takes > 0").limit(1).count():
        # Chains, or records that name several: captures are the components of the links.
        roots = components(links.select(F.xxhash64("u").alias("a"), F.xxhash64("v").alias("b")))
        own = F.xxhash64("record_id")
        known = records.withColumn("node", own).join(roots, "node", "left").withColumn("key", F.coalesce("root", "node").cast("string"))
    else:
        known = records.withColumn("key", main)
    whole = F.struct("record_id", "type", "target", "refers_to", "payload_digest", "date", "headers", "content", "payload_bytes", "payload_sha1")

    def part(*types: str) -> F.Column:
        return F.max_by(F.when(F.col("type").isin(*types), whole), F.when(F.col("type").isin(*types), F.col("record_id")))

    out = known.groupBy("key").agg(part("response", "revisit").alias("response"), part("request").alias("request"), part("metadata").alias("metadata"), F.count(F.lit(1)).alias("records"), F.min(main).alias("named"))
    return out.select(F.coalesce("response.record_id", "named").alias("capture_id"), "response", "request", "metadata", "records")


def op3_warc(spark, sf_dir: str) -> DataFrame:
    """Contract query: writes all pages as archives, reads them back and assembles the captures."""
    path = fresh(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    captures = assemble(read_warc(spark, path, content=False))
    r = F.col("response")
    captures = captures.select("capture_id", r["type"].alias("record_type"), r["refers_to"].alias("refers"), r["payload_digest"].alias("digest"), r["payload_bytes"].alias("bytes"), r["payload_sha1"].alias("sha1"), F.regexp_extract("metadata.content", r"pageId: (-?\d+)", 1).try_cast("long").alias("page_id"))
    captures = table(captures, "warc-captures")
    remove(spark, path)
    # A revisit names the response's id, or, where equal rows gave several responses, their payload's digest alone.
    responses = captures.filter("record_type = 'response'")
    heads = responses.select(F.explode(F.array("capture_id", F.when(F.col("bytes") >= REVISIT_FROM, F.col("sha1")))).alias("refers"), "page_id", "bytes", "sha1")
    heads = heads.filter("refers is not null").groupBy("refers").agg(F.max(F.struct("page_id", "bytes", "sha1")).alias("head"))
    revisits = captures.filter("record_type = 'revisit'").withColumn("refers", F.coalesce("refers", "digest")).join(heads, "refers", "left")
    out = responses.select("page_id", F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    return out.union(revisits.select("page_id", "head.bytes", "head.sha1", "record_type", "head.page_id"))


#: The contract's rows from the table alone.
ORACLE = """with p as (select page_id, cast(strlen(coalesce(html, '')) as bigint) payload_bytes, sha1(coalesce(html, '')) payload_digest from pages),
    h as (select payload_digest, max(page_id) head from p where payload_bytes >= 1000 group by 1)
    select page_id, payload_bytes, payload_digest, case when page_id < head then 'revisit' else 'response' end record_type,
        case when page_id < head then head end refers_to from p left join h using (payload_digest)"""
