import gzip
import hashlib
import re

from tidemart.llm import warc

PAGE = ("<!doctype html><html><head><title>A &amp;\n b</title><style>p{}</style><SCRIPT>var t='</p>';</SCRIPT></head><body><!-- no -->"
        "<p>One&nbsp;two<br>three <b>fo</b>ur</p><a  href='/x'>link</a> &lt;kept&gt; é</body></html>")


def records(spark, pages):
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, block string")
    return warc.derivatives(warc.responses(frame))


def test_records(spark):
    rows = {r.warc_type: r for r in records(spark, [(1, "http://x/", PAGE, "clash")]).collect()}
    text, meta = rows["conversion"], rows["metadata"]
    assert text.block == "A &\n b\nOne two\nthree four\nlink <kept> é".replace("&\n b", "& b").replace("A & b", "A &\nb")
    assert text.refers_to == meta.refers_to != text.record_id != meta.record_id
    assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", text.record_id)
    for r in rows.values():
        assert r.payload_digest == "sha256:" + hashlib.sha256(PAGE.encode()).hexdigest()
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert r.content_length == len(r.block.encode()) and r.header.endswith(f"Content-Length: {r.content_length}\r\n\r\n")
        assert f"WARC-Refers-To: {r.refers_to}\r\n" in r.header and f"WARC-Refers-To-Payload-Digest: {r.payload_digest}\r\n" in r.header
    fields = dict(line.split(": ", 1) for line in meta.block.splitlines() if not line.startswith("source-header"))
    assert fields["title"] == "A &amp; b" and fields["links"] == "1" and fields["conversion-record"] == text.record_id
    assert f"source-header: Content-Length: {len(PAGE.encode())}" in meta.block


def test_odd_pages(spark):
    pages = [(1, None, None, ""), (None, "u", "", ""), (2, "u", "plain", ""), (2, "u", "plain", ""), (3, "u", "<script>open " + "x" * 200_000, ""),
             (4, "u", "<p>" * 20_000 + "deep", "")]
    rows = records(spark, pages).collect()
    assert len(rows) == 2 * len(pages)
    texts = {(r.page_id, r.block) for r in rows if r.warc_type == "conversion"}
    assert {(1, ""), (None, ""), (2, "plain"), (4, "deep")} <= texts
    assert records(spark, []).count() == 0


def test_files(spark, tmp_path):
    out = records(spark, [(k, f"http://x/{k}", PAGE, "") for k in range(5)])
    warc.write_files(out, str(tmp_path / "w"))
    data = b"".join(gzip.open(f).read() for f in sorted((tmp_path / "w").glob("*.gz")))
    found, at = [], 0
    while at < len(data):  # records follow one another by their stated lengths
        head = data[at:data.index(b"\r\n\r\n", at) + 4].decode()
        n = int(re.search(r"Content-Length: (\d+)", head)[1])
        at += len(head.encode())
        found.append((re.search("WARC-Record-ID: (.*)\r", head)[1], data[at:at + n].decode()))
        assert data[at + n:at + n + 4] == b"\r\n\r\n"
        at += n + 4
    assert sorted(found) == sorted((r.record_id, r.block) for r in out.collect())
