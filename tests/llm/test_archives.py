import gzip
import hashlib
import random

import pytest

from pagemart.llm import archives
from pagemart.session import scratch_path
from tools_check import compare, connect

FORGED = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\nfiledesc://x 0.0.0.0 20000101000000 text/plain 9\nhttp://a/ 1.1.1.1 20000101000000 text/html 5\n"


def plain(rows):
    payloads = [((t or "").encode(), i) for i, t in rows]
    out = []
    for n, (body, i) in enumerate(payloads):
        same = [(j is None, j or 0, m) for m, (b, j) in enumerate(payloads) if b == body]
        first = min(same)[2] if len(body) >= 100 else n
        kept = payloads[first][1]
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "response" if first == n else "revisit", None if first == n else kept))
    return sorted(out, key=repr)


def rows():
    rng = random.Random(1)
    pool = ["x" * 99, "x" * 100, "ü" * 50, "<p>" + FORGED * 3, "\n" * 150, "\r\n\r\n" * 40, "HTTP/1.1 200 OK\r\n\r\n" * 9, *("page %d " % k * 20 for k in range(9))]
    made = [(i, rng.choice(pool)) for i in range(120)]
    hot = [(i, "the same long page everywhere " * 5) for i in range(500, 640)]
    return [*made, *hot, (7, made[7][1]), (7, made[7][1]), (None, pool[3]), (None, None), (900, None), (901, ""), (902, "z" * 40_000), (-5, pool[1])]


@pytest.mark.parametrize("limits", [{}, {"archive_bytes": 2000, "broadcast_rows": 0}, {"versions": (1,)}, {"versions": (2,)}])
def test_round_trip(spark, limits):
    some = rows()
    urls = ["http://a.example/x y", None, "http://ü.example/é?q=1#z", "", "https://b.example/\n", "http://c.example/100%"]
    docs = spark.createDataFrame([(i, urls[k % 6], t, "d", 1) for k, (i, t) in enumerate(some)], "page_id long, url string, html string, digest string, offset int")
    got = archives.archived(docs.repartition(3), **limits)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    # Which of two equal rows is the response is open: both have the same id.
    assert sorted(map(tuple, got.collect()), key=repr) == plain(some)


def test_text_ids_and_empty_table(spark):
    same = "words " * 30
    docs = spark.createDataFrame([("b é%20", same), ("a b", same), (None, same)], "page_id string, html string").selectExpr("page_id", "'u' as url", "html")
    got = {r.page_id: (r.record_type, r.refers_to) for r in archives.archived(docs).collect()}
    assert got == {"a b": ("response", None), "b é%20": ("revisit", "a b"), None: ("revisit", "a b")}
    assert archives.archived(docs.limit(0)).count() == 0


def test_one_very_long_page(spark):
    text = "<p>long é page</p>\r\n\r\n" * 1_500_000
    docs = spark.createDataFrame([(1, "u", text), (2, "u", text), (3, "u", "short")], "page_id long, url string, html string")
    assert sorted(map(tuple, archives.archived(docs).collect())) == plain([(1, text), (2, text), (3, "short")])


def arc(version, *records, names=True):
    fields = (" ".join(archives.ARC_FIELDS[version]) + "\n") * names
    body = f"{version} 0 crawler\n{fields}".encode()
    middle = "" if version == 1 else "200 - - 0 f.arc "
    return b"".join([f"filedesc://f.arc 0.0.0.0 20010203040506 text/plain {middle}{len(body)}\n".encode(), body, *(b"\n" + r for r in records)])


HTTP = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\nhello"


@pytest.mark.parametrize("names", [True, False])
def test_reads_both_versions(names):
    one = arc(1, b"http://a/ 1.2.3.4 200102030405 text/html %d\n" % len(HTTP) + HTTP, b"\r\ndns:a 1.2.3.4 20010203 text/dns 3\nabc\n", names=names)
    got = list(archives.read_arc(one))
    assert [(r.url, r.ip, r.date, r.mime, r.body, bool(r.head)) for r in got] == [
        ("http://a/", "1.2.3.4", "200102030405", "text/html", b"hello", True), ("dns:a", "1.2.3.4", "20010203", "text/dns", b"abc", False)]
    two = arc(2, b"http://a/b c 1.2.3.4 20010203040506 text/html 200 0af - 7 f.arc %d\n" % (len(HTTP) + 4) + HTTP, names=names)
    (r,) = archives.read_arc(two)
    assert (r.url, r.body, r.truncated) == ("http://a/b c", b"hello", True)


def test_bad_archives_raise():
    for bad in (b"http://a/ 1.2.3.4 20010203040506 text/html 5\nhello", arc(1, b"no header line here\n"), arc(2, b"u i d m 5\nhello"), b"filedesc://f 0 0 t 4\n9 0\n\nu i d m 1\nx"):
        with pytest.raises(ValueError):
            list(archives.read_arc(bad))
    for bad in (b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc", b"nothing\r\n\r\n"):
        with pytest.raises(ValueError):
            list(archives.read_warc(bad))


@pytest.mark.parametrize(("date", "wanted"), [
    ("20010203040506", "2001-02-03T04:05:06Z"), ("200102030405", "2001-02-03T04:05:00Z"), ("20010203", "2001-02-03T00:00:00Z"), ("x", "1970-01-01T00:00:00Z")])
def test_dates(date, wanted):
    assert archives.warc_date(date) == wanted


def test_converted_files_are_warc(spark, tmp_path):
    """Legacy files, one of them gzipped record by record; all header fields that the conversion makes."""
    body = b"HTTP/1.1 200 OK\r\nContent-Length: 120\r\nX-Row-Id: %d\r\n\r\n" + b"y" * 120
    records = [b"http://a/%d 1.2.3.4 20010203040506 text/html %d\n" % (i, len(body % i)) + body % i for i in (3, 1)]
    first = arc(1, records[0], b"dns:a 0.0.0.0 20010203040506 text/dns 3\nabc")
    (tmp_path / "one.arc.gz").write_bytes(b"".join(gzip.compress(p) for p in (first[:150], first[150:])))
    (tmp_path / "two.arc").write_bytes(arc(1, records[1]))
    path = archives.arc_to_warc(spark, f"file://{tmp_path}", scratch_path(spark, "warc"))
    files = [archives.unzipped(r.content) for r in archives.archive_files(spark, path).collect()]
    assert all(f.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and f.endswith(b"\r\n\r\n") for f in files)
    found = {f["warc-target-uri"]: (f, b) for file in files for f, b in archives.read_warc(file) if f["warc-type"] != "warcinfo"}
    response, revisit, resource = (found[u][0] for u in ("http://a/1", "http://a/3", "dns:a"))
    assert (response["warc-type"], revisit["warc-type"], resource["warc-type"]) == ("response", "revisit", "resource")
    assert revisit["warc-refers-to"] == response["warc-record-id"] != revisit["warc-record-id"] and revisit["warc-profile"] == archives.PROFILE
    assert revisit["warc-refers-to-date"] == response["warc-date"] == "2001-02-03T04:05:06Z"
    assert revisit["warc-payload-digest"] == response["warc-payload-digest"] == "sha256:" + hashlib.sha256(b"y" * 120).hexdigest()
    assert found["http://a/3"][1] == (body % 3)[:-120] and found["http://a/1"][1] == body % 1 and found["dns:a"][1] == b"abc"
    rows_read = {r.url: (r.row_id, r.payload_bytes, r.refers_to) for r in archives.warc_records(spark, path).collect()}
    assert rows_read == {"http://a/1": ("1", 120, None), "http://a/3": ("3", 120, "1"), "dns:a": (None, 3, None)}


def test_against_sql(spark):
    ok, message = compare(spark, connect("/root/testdata/sf0.01"), archives.op12_arc_to_warc, archives.ORACLE, "/root/testdata/sf0.01")
    assert ok and "TYPES" not in message, message
