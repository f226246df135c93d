import gzip
import hashlib
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from sitewise.llm import warc as W


def brute(rows, least=1000):
    """(page_id, bytes, digest, type, refers_to) of rows (page_id, url, html)."""
    low = lambda x: (x is not None, x or 0)
    groups = {}
    for k, (i, u, h) in enumerate(rows):
        groups.setdefault((h or "").encode(), []).append((low(i), (u is not None, u or ""), k))
    out = []
    for body, members in groups.items():
        top = max(members)
        for m in members:
            revisit = len(body) >= least and m is not top
            out.append((rows[m[2]][0], len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", rows[top[2]][0] if revisit else None))
    return Counter(out)


def awkward_pages():
    rng = random.Random(5)
    long = ["".join(rng.choice("abc <>é\r\n日") for _ in range(n)) for n in (999, 1000, 3000, 200_000)]
    rows = [(1, "http://a/1", None), (2, None, ""), (3, "http://a/3\r\nX: y", "short"), (4, "http://a/4", "short"), (None, "u", long[2]), (None, "v", long[1])]
    rows += [(10 + k, f"http://b/{k}", rng.choice(long)) for k in range(40)]
    rows += [(7, "http://same", "q" * 1000)] * 3 + [(99, "http://tie", "r" * 2000)] * 4 + [(98, "http://tie", "r" * 2000)] * 2 + [(None, None, "s" * 1500)] * 3
    rows += [(200, "http://t/1", "t" * 1001), (200, "http://t/2", "t" * 1001)]
    return rows + [(300 + k, "http://many", "m" * 1200) for k in range(300)]


def read_back(spark, tmp_path, rows, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("top", F.lit(1)).withColumn("payload", F.lit("x"))
    W.write_warc(W.deduplicated(pages), str(tmp_path), **options)
    return W.page_records(spark, str(tmp_path))


@pytest.mark.parametrize("options", [{}, {"compression": "none"}, {"fileBytes": "5000"}])
def test_round_trip_against_brute_force(spark, tmp_path, options):
    rows = awkward_pages()
    got = Counter(tuple(r) for r in read_back(spark, tmp_path / "w", rows, **options).collect())
    assert got == brute(rows)
    if "fileBytes" in options:
        assert len(list((tmp_path / "w").glob("*.warc.gz"))) > 20


def test_oracle_on_awkward_rows(spark, tmp_path):
    rows = [r for r in awkward_pages() if "\0" not in (r[2] or "")]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert Counter(con.execute(W.oracle()).fetchall()) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert read_back(spark, tmp_path / "w", []).collect() == []


def three(tmp_path, name="a.warc"):
    """A foreign archive: other line ends in blocks, folded and repeated headers, no length in its members."""
    one = lambda kind, uri, block, more="": (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{uri}>\r\nWARC-Target-URI: {uri}\r\n{more}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n")
    big = random.Random(1).randbytes(300_000)
    parts = [one("warcinfo", "i", b"software: x\r\n", "Content-Type: application/warc-fields\r\n"),
             one("response", "http://x/1", b"HTTP/1.1 404 Gone\r\nA: 1\r\nA: 2\r\n\r\nWARC/1.0\r\n\r\n" + big, "Content-Type: application/http; msgtype=response\r\nX-Long: one\r\n two\r\n"),
             one("request", "http://x/1", b"GET / HTTP/1.1\r\nHost: x\r\n", "Content-Type: application/http; msgtype=request\r\n"),
             one("response", "http://y/2", b"", "WARC-Date: 2020-01-01T00:00:00Z\r\n"), one("conversion", "http://y/3", b"text", "Content-Type: text/plain\r\n")]
    return parts, big


@pytest.mark.parametrize("form", ["plain", "members", "whole"])
def test_foreign_archives(spark, tmp_path, form):
    parts, big = three(tmp_path)
    data = {"plain": b"".join(parts), "members": b"".join(gzip.compress(p) for p in parts), "whole": gzip.compress(b"".join(parts))}[form]
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / ("a.warc" if form == "plain" else "a.warc.gz")).write_bytes(data)
    (tmp_path / "notes.txt").write_text("no archive")
    df = W.read_warc(spark, str(tmp_path))
    rows = {r.warc_type + r.target_uri: r for r in df.collect()}
    assert len(rows) == 5
    r = rows["responsehttp://x/1"]
    assert bytes(r.payload) == b"WARC/1.0\r\n\r\n" + big and r.http_headers == {"A": "1"} and r.headers["X-Long"] == "one two"
    assert rows["requesthttp://x/1"].http_headers["Host"] == "x" and rows["requesthttp://x/1"].payload == b""
    assert bytes(rows["conversionhttp://y/3"].payload) == b"text" and rows["conversionhttp://y/3"].http_headers is None
    two = df.where("warc_type = 'response'").union(df.where("warc_type = 'request'"))
    assert Counter(x.warc_type for x in two.collect()) == {"response": 2, "request": 1} and df.count() == 5
    assert all(x.payload is None for x in W.read_warc(spark, str(tmp_path), payload=False).collect())


def test_filters_are_pushed_and_right(spark, tmp_path):
    parts, _ = three(tmp_path)
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    df = W.read_warc(spark, str(tmp_path))
    local = spark.createDataFrame(df.collect(), df.schema)
    conds = ["warc_type = 'response'", "warc_type in ('request', 'conversion')", "not warc_type = 'response'", "date is null", "content_length > 100000", "target_uri like 'http://x%'", "target_uri like '%2'",
             "target_uri like '%y%'", "date > '2019' and warc_type <> 'request'", "warc_type <=> 'request'", "headers['X-Long'] = 'one two'", "not date = '2020-01-01T00:00:00Z'", "date is not null",
             "warc_type = 'response' or content_length < 10", "file like '%.txt'", "upper(warc_type) = 'RESPONSE' and content_length = 0"]
    for k, cond in enumerate(conds):
        want = sorted(x.offset for x in local.where(cond).collect())
        assert sorted(x.offset for x in W.read_warc(spark, str(tmp_path), cond, payload=k % 2 == 0).collect()) == want, cond
    plan = W.read_warc(spark, str(tmp_path), "warc_type = 'response'")._jdf.queryExecution().executedPlan().toString()
    assert "= response" not in plan  # the source took it


def test_unwanted_payloads_are_not_inflated(tmp_path, monkeypatch):
    body = b"".join(W.member(W.record({"warc_type": k, "payload": random.Random(i).randbytes(400_000)}), 1) for i, k in enumerate(["response", "other", "response", "other"]))
    (tmp_path / "a.warc.gz").write_bytes(body)
    made = []
    whole = W.Inflated.more
    monkeypatch.setattr(W.Inflated, "more", lambda self: (out := whole(self), made.append(len(self.buffer)))[0])
    r = W.Reader({"path": str(tmp_path)})
    assert list(r.pushFilters([W.ds.EqualTo(("warc_type",), "other"), W.ds.EqualTo(("headers", "x"), "y")])) == [W.ds.EqualTo(("headers", "x"), "y")]
    assert sum(len(b) for p in r.partitions() for b in r.read(p)) == 2
    assert sum(made) < 2 * 400_000 + 6 * W.CHUNK
    made.clear()
    assert sum(len(b) for p in W.Reader({"path": str(tmp_path), "payload": "false"}).partitions() for b in W.Reader({"path": str(tmp_path), "payload": "false"}).read(p)) == 4
    assert sum(made) < 6 * W.CHUNK


@pytest.mark.parametrize("cut", [10, 200, 5_000])
def test_broken_files(spark, tmp_path, cut):
    parts, _ = three(tmp_path)
    whole = b"".join(gzip.compress(p) for p in parts[:2])
    (tmp_path / "a.warc.gz").write_bytes(whole[: len(gzip.compress(parts[0])) + cut])
    (tmp_path / "b.warc").write_bytes(parts[3] + b"rubbish\n")
    with pytest.raises(Exception, match="gzip member|inside|begins"):
        W.read_warc(spark, str(tmp_path)).collect()
    assert sorted(r.warc_type for r in W.read_warc(spark, str(tmp_path), broken="stop").collect()) == ["response", "warcinfo"]


def test_files_of_failed_tasks_are_not_read(spark, tmp_path):
    W.write_warc(spark.createDataFrame([(b"one", "resource")], "payload binary, warc_type string"), str(tmp_path))
    W.write_warc(spark.createDataFrame([(b"two", None)], "payload binary, other string"), str(tmp_path))
    (tmp_path / "part-00000-left-0.warc.gz").write_bytes(W.member(W.record({"payload": b"three"}), 6))
    assert sorted(bytes(r.payload) for r in W.read_warc(spark, str(tmp_path)).collect()) == [b"one", b"two"]


def test_partitions_hold_several_small_files(tmp_path):
    for k in range(10):
        (tmp_path / f"{k}.warc").write_bytes(b"x" * 100)
    assert [len(p.names) for p in W.Reader({"path": str(tmp_path), "partitionBytes": "250"}).partitions()] == [2] * 5
    assert [len(p.names) for p in W.Reader({"path": str(tmp_path), "partitionBytes": "50"}).partitions()] == [1] * 10
