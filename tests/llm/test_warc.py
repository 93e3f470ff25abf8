"""Archives: round trips, predicates that skip, and pages without repeated payloads."""

import base64
import collections
import gzip
import hashlib
import io
import os

import pyarrow as pa
import pytest
from pyspark.sql import datasource as D
from pyspark.sql import functions as F

from verdigris.llm import warc

PAGE = "page_id long, url string, html string, payload string, first long, record_type string"
LONG = "<p>" + "é x" * 60000


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.fixture(scope="module")
def pages():
    html = ["<a>", "<a>", None, "", LONG, "<b>", "<a>", "é", LONG, "\r\n\r\nWARC/1.1\r\n\r\n"]
    rows = [(2 ** 53 + 1 + 7 * i % 10, f"http://h/{i}\n\t?é", h, "p", 3, "t") for i, h in enumerate(html)]
    return [*rows, rows[5], rows[0], (None, None, "<a>", *[None] * 3), (None, None, "<only>", *[None] * 3), (-4, "", "<neg>", *[None] * 3)]


def contract(rows, least=0):
    data = [(p, (h or "").encode()) for p, _, h, *_ in rows]
    first = {}
    for p, d in data:
        first[d] = max((x for x in (first.get(d), p) if x is not None), default=None)
    out = []
    for p, d in data:
        again = len(d) >= least and first[d] is not None and p != first[d]
        out.append((p, len(d), digest(d), "revisit" if again else "response", first[d] if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 3])
def test_pages(spark, pages, least):
    got = warc.archived_pages(spark.createDataFrame(pages, PAGE).repartition(4), least).collect()
    assert sorted(map(tuple, got), key=repr) == contract(pages, least)
    assert warc.archived_pages(spark.createDataFrame([], PAGE), least).count() == 0


def test_hot_payloads(spark):
    rows = [(i, "u", "same" if i % 3 else f"other {i % 500}", *[None] * 3) for i in range(1500)]
    got = warc.archived_pages(spark.createDataFrame(rows, PAGE).repartition(4)).collect()
    assert sorted(map(tuple, got), key=repr) == contract(rows)


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """Archives of 300 records, plain and as gzip members, of several files each."""
    warc.register(spark)
    rows = [(("response", "revisit", "response")[i % 3], f"urn:r:{i}", f"http://h{i % 7}/{i}", None if i % 3 != 1 else f"urn:r:{i - 1}",
             None if i % 3 == 1 else f"body {i} ".encode() * (i % 50), 5) for i in range(300)]
    df = spark.createDataFrame(rows, "record_type string, record_id string, target_uri string, refers_to string, payload binary, payload_length long")
    out = {}
    for kind in ("none", "gzip"):
        out[kind] = str(tmp_path_factory.mktemp("warc") / kind)
        for _ in range(2):  # overwritten by the second
            df.repartition(3).write.format("warc").mode("overwrite").option("compression", kind).option("maxBytes", 20000).save(out[kind])
    return rows, out


@pytest.mark.parametrize("kind", ["none", "gzip"])
def test_round_trip(spark, written, kind):
    rows, paths = written
    assert len(os.listdir(paths[kind])) >= 3 and not any(x.startswith("_") for x in os.listdir(paths[kind]))
    df = spark.read.format("warc").option("maxBytes", 20000).load(paths[kind])
    got = {r["record_id"]: r for r in df.where("record_type <> 'warcinfo'").collect()}
    assert len(got) == len(rows)
    for t, i, uri, to, payload, _ in rows:
        r, data = got[i], payload or b""
        assert (r["record_type"], r["target_uri"], r["refers_to"], r["date"]) == (t, uri, to, warc.DATE)
        assert r["payload_digest"] == digest(data) and r["payload_length"] == (5 if t == "revisit" else len(data))
        assert (r["payload"] and bytes(r["payload"])) == (None if t == "revisit" else data) or not data
    assert df.where("record_type = 'warcinfo'").count() >= 3


PREDICATES = ["record_type = 'revisit'", "target_uri LIKE 'http://h3/%'", "refers_to IS NULL AND record_type IN ('response', 'revisit')",
              "NOT target_uri LIKE '%9' AND record_type = 'response'", "record_type = 'response' AND payload_length > 100",
              "target_uri <> 'http://h0/0'", "refers_to IS NOT NULL OR payload_length = 0", "record_id <=> 'urn:r:7'"]


@pytest.mark.parametrize("predicate", PREDICATES)
@pytest.mark.parametrize("payload", ["full", "none"])
def test_predicates(spark, written, predicate, payload):
    rows, paths = written
    want = spark.createDataFrame([(*r[:4], r[5] if r[0] == "revisit" else len(r[4])) for r in rows],
                                 "record_type string, record_id string, target_uri string, refers_to string, payload_length long")
    want = sorted(r[0] for r in want.where(predicate).select("record_id").collect())
    for path in paths.values():
        df = spark.read.format("warc").option("payload", payload).load(path).where(predicate)
        assert sorted(r[0] for r in df.where("record_type <> 'warcinfo'").select("record_id").collect()) == want


def test_pushed_predicates_leave_the_plan(spark, written):
    df = spark.read.format("warc").load(written[1]["gzip"]).where("record_type = 'revisit' AND payload_length > 3")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "payload_length" in plan.split("Filter")[1].split("\n")[0] and "= revisit" not in plan.split("Filter")[1].split("\n")[0]


def _stream(data, cls=warc._Gzip):
    return cls(pa.PythonFile(io.BytesIO(data), mode="r"), "x")


def test_unwanted_payloads_are_not_inflated():
    big = [{"record_type": "response", "record_id": f"urn:{i}", "target_uri": "http://h", "payload": os.urandom(400_000)} for i in range(5)]
    data = b"".join(warc.member(warc.record(r)) for r in big)
    stream = _stream(data)
    got = list(warc.records(stream, lambda row: row["record_id"] == "urn:3", "full"))
    assert [r["payload"] for r in got] == [big[3]["payload"]]
    assert stream.inflated < 400_000 + 6 * 2 * warc.READ
    stream = _stream(data)
    assert [r["payload_length"] for r in warc.records(stream, lambda row: True, "none")] == [400_000] * 5
    assert stream.inflated < 6 * 2 * warc.READ


def test_foreign_files():
    """One gzip member for several records, no lengths, folded headers, other record types; and broken files."""
    raw = (b"WARC/1.0\r\nwarc-type: request\r\nWARC-Record-ID: <urn:a>\r\nWARC-Target-URI: http://x/\r\n  y\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
           b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Type: text/plain\r\nContent-Length: 5\r\n\r\n\r\n\r\nz\r\n\r\n")
    want = [("request", "urn:a", "http://x/ y", b"abc"), ("resource", None, None, b"\r\n\r\nz")]
    for stream in (_stream(raw, warc._Plain), _stream(gzip.compress(raw)), _stream(gzip.compress(raw[:100]) + gzip.compress(raw[100:]))):
        got = list(warc.records(stream, lambda row: True, "full"))
        assert [(r["record_type"], r["record_id"], r["target_uri"], r["payload"]) for r in got] == want
    for data, cls in ((raw[:-9], warc._Plain), (gzip.compress(raw)[:-20], warc._Gzip), (raw[:30], warc._Plain), (b"no header\r\n\r\n", warc._Plain)):
        with pytest.raises(ValueError):
            list(warc.records(_stream(data, cls), lambda row: False, "full"))


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    warc.register(spark)
    bad = spark.range(100).select(F.lit("response").alias("record_type"), F.col("id").cast("string").alias("record_id"), F.lit("u").alias("target_uri"),
                                  F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.lit("x")).alias("payload"))
    with pytest.raises(Exception, match="lost"):
        bad.repartition(2).write.format("warc").mode("append").save(str(tmp_path / "a"))
    assert not os.path.isdir(tmp_path / "a") or os.listdir(tmp_path / "a") == []


def test_filters_with_nulls():
    row = collections.defaultdict(lambda: None, record_type="response")
    assert warc._holds(D.Not(D.EqualTo(("refers_to",), "a")), row) is None
    assert warc._holds(D.Not(D.In(("record_type",), ("a", "b"))), row) is True
    assert not warc._on_header(D.In(("record_type",), ("a", None))) and not warc._on_header(D.GreaterThan(("date",), "a"))
