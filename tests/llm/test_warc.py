import hashlib
from html.parser import HTMLParser

from flightlake.llm import queries, warc

SF001 = "/root/testdata/sf0.001"


class Plain(HTMLParser):
    """What a reader sees, with the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "title")
        if tag in warc._BLOCK:
            self.out.append("\n")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "title")
        if tag in warc._BLOCK:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)

    def text(self):
        return "\n".join(x for x in (" ".join(y.split()) for y in "".join(self.out).split("\n")) if x)


def test_text_against_a_parser(spark):
    for r in spark.read.parquet(f"{SF001}/pages.parquet").collect():
        p = Plain()
        p.feed(r.html)
        p.close()
        assert warc.html_to_text(r.html)[0] == p.text()


def test_text_of_odd_markup():
    text, title, links = warc.html_to_text(
        '<TITLE> A &amp;\n B </TITLE><p>one<br>two &lt;b&gt; <b title="x > y">bold</b><script>var a="</p>";</script>'
        "<!-- no > --><style>p{}</style><a href='/x?a=1&amp;b=2'>go</a><div>end<unclosed")
    assert (text, title, links) == ("one\ntwo <b> boldgo\nend<unclosed", "A & B", ["/x?a=1&b=2"])
    assert warc.html_to_text("") == ("", "", [])


PAGES = [(1, "http://a.com/", "<title>T</title><p>hello &eacute;</p>"), (2, None, None), (3, "", ""), (4, "u\r\nInjected: x", "<p>x"),
         (5, "http://b.com/", "<p>" + "long " * 100_000), (6, "http://a.com/", "<title>T</title><p>hello &eacute;</p>")]


def test_records_link_and_verify(spark):
    pages = spark.createDataFrame([(*p, "kept") for p in PAGES], "page_id long, url string, html string, error string")
    responses = warc.page_responses(pages)
    sources = {r.page_id: warc.parse_record(bytes(r.record)) for r in responses.collect()}
    rows = warc.build_derivatives(responses).collect()
    assert sorted(r.page_id for r in rows) == sorted([p[0] for p in PAGES] * 2)
    for r in rows:
        fields, body = warc.parse_record(bytes(r.record))
        source, source_body = sources[r.page_id]
        html = (dict((p[0], p[2]) for p in PAGES)[r.page_id] or "").encode()
        assert source_body.endswith(b"\r\n\r\n" + html)
        assert source["warc-payload-digest"] == "sha256:" + hashlib.sha256(html).hexdigest()
        assert source["warc-block-digest"] == warc.digest(source_body)
        assert fields["warc-refers-to"] == source["warc-record-id"]
        assert fields["warc-refers-to-target-uri"] == fields["warc-target-uri"] == source["warc-target-uri"]
        assert fields["warc-refers-to-date"] == source["warc-date"]
        assert fields["warc-block-digest"] == warc.digest(body) and int(fields["content-length"]) == len(body)
        assert "injected" not in fields
        if fields["warc-type"] == "conversion":
            assert body.decode() == warc.html_to_text(html.decode())[0]
        else:
            assert f"source-payload-digest: {source['warc-payload-digest']}\r\n".encode() in body
            assert b"http-header: Content-Type: text/html; charset=utf-8\r\n" in body


def test_other_and_broken_records(spark):
    image = warc.build_record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>")],
                              b"HTTP/1.1 404 Not Found\r\nContent-Type: image/png\r\n\r\n\x89PNG")
    latin = warc.build_record([("WARC-Type", "response")], b"HTTP/1.0 200\r\nContent-Type: text/plain; charset=latin-1\r\n\r\n\xe9")
    info = warc.build_record([("WARC-Type", "warcinfo")], b"x")
    records = [(1, image), (2, latin), (3, info), (4, None), (5, b""), (6, image[:40]), (7, image[:-10]),
               (8, warc.build_record([("WARC-Type", "response")], b"nothing"))]
    got = {}
    for r in warc.build_derivatives(spark.createDataFrame(records, "k int, record binary")).collect():
        got.setdefault(r.k, []).append((r.record and warc.parse_record(bytes(r.record))[0]["warc-type"], r.error))
    assert got[1] == [("metadata", None)] and sorted(got[2]) == [("conversion", None), ("metadata", None)]
    assert 3 not in got and all(got[k][0][0] is None and got[k][0][1] for k in (4, 5, 6, 7, 8))
    assert warc.parse_record(warc.derive(latin)[1])[1] == "\u00e9".encode()


def test_files_round_trip(spark, tmp_path):
    records = [warc.build_record([("WARC-Type", "resource"), ("N", str(i))], b"\r\n\r\n" * i) for i in range(5)]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(warc.compress_record, records)))
    got = [bytes(r.record) for r in warc.read_files(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(records * 2)


def test_query_covers_all_pages(spark):
    rows = queries.op8_warc_derivatives(spark, SF001).collect()
    pages = spark.read.parquet(f"{SF001}/pages.parquet").collect()
    assert sorted((r.page_id, r.record_type) for r in rows) == sorted(
        (p.page_id, t) for p in pages for t in ("metadata", "conversion"))
    assert all(r.block_digest == "sha256:" + r.body_sha256 and r.error is None for r in rows)


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_records(warc.build_derivatives(warc.page_responses(pages))).collect() == []


def test_clashing_columns_are_replaced(spark):
    pages = spark.createDataFrame([(1, "http://a.b/", "<p>x</p>")], "page_id long, url string, html string")
    derived = warc.build_derivatives(warc.page_responses(pages)).selectExpr("*", "'x' AS date", "'y' AS Body", "1 AS target_uri")
    rows = warc.read_records(derived).collect()
    assert {r.record_type for r in rows} == {"metadata", "conversion"} and {r.target_uri for r in rows} == {"http://a.b/"}


def test_splitting_a_file_is_linear():
    import io
    import time

    def record(i):
        body = bytes([i % 251]) * 5000 + b"\r\n\r\nContent-Length: 3\r\n\r\n"
        return b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n" % (len(body), body)

    took = []
    for n in (1000, 8000):
        records = [record(i) for i in range(n)]
        for content in (b"".join(records), b"".join(map(warc.compress_record, records))):
            began = time.thread_time()
            assert list(warc.split_file(content)) == records
            took.append(time.thread_time() - began)
    assert took[2] + took[3] < 30 * (took[0] + took[1] + 0.05)
    whole = b"".join(records[:50])
    assert list(warc.split_stream(io.BytesIO(whole), block=7)) == records[:50]
    packed = b"".join(map(warc.compress_record, records[:5]))
    assert list(warc.split_stream(io.BytesIO(packed), block=11)) == records[:5]
    import pytest
    with pytest.raises(ValueError):
        list(warc.split_file(packed[:-4]))
    with pytest.raises(ValueError):
        list(warc.split_file(whole + b"rest"))
