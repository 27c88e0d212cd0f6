"""ARC archives to WARC: formats, lengths, revisits, round trips."""

import base64
import gzip
import hashlib

import pytest

from wardstat.llm import arc_convert as arc
from wardstat.session import scratch_path

V1 = (
    b"filedesc://old.arc 0.0.0.0 19970101000000 text/plain 76\n1 0 Archive\nURL IP-address Archive-date Content-type Archive-length\n\n\n"
    b"http://a.example/ 1.2.3.4 19970102030405 text/html 48\nHTTP/1.0 200 OK\r\nX-Page-Id: 7\r\n\r\nnot\r\n\r\nthe end\n\n"
    b"\n"
    b"http://a.example/x y 1.2.3.4 1997 text/plain 3\nabc\n"
)
V2 = (
    b"filedesc://new.arc 0.0.0.0 19990101 text/plain - - - - new.arc 123\n2 0 Archive\n"
    b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n\n12345678\n"
    b"http://b.example/ 1.2.3.4 19990102030405 text/html 200 x - 190 new.arc 0\n\n"
)


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def fixed(data, wrong):
    """The file with the declared length of the version block put right."""
    head, _, rest = data.partition(b"\n")
    body = rest[: rest.index(b"-length\n") + len(b"-length\n")]
    return head.replace(wrong, str(len(body)).encode()) + b"\n" + body + b"\n" + rest[rest.index(b"http://") :]


@pytest.mark.parametrize("zipped", [False, True])
def test_both_versions_are_parsed_by_their_lengths(zipped):
    data = fixed(V1, b"76")
    if zipped:  # several members, cut anywhere
        data = gzip.compress(data[:150]) + gzip.compress(data[150:])
    first, page, plain = arc.parse_arc(data)
    assert first.url == "filedesc://old.arc"
    assert (page.url, page.payload, page.header("x-page-id"), page.date) == ("http://a.example/", b"not\r\n\r\nthe end\n", "7", "19970102030405")
    assert (plain.url, plain.content, plain.head_length) == ("http://a.example/x y", b"abc", 0)
    _, empty = arc.parse_arc(fixed(V2, b"123"))
    assert (empty.url, empty.content, empty.date) == ("http://b.example/", b"", "19990102030405")


@pytest.mark.parametrize("bad", [
    b"http://a/ 1.2.3.4 19970102030405 text/html 3\nabc\n",
    b"filedesc://x 0.0.0.0 1 text/plain 2\nab\n",
    b"filedesc://x 0.0.0.0 1 text/plain 99\nab\n",
    fixed(V1, b"76").replace(b"text/plain 3", b"text/plain 2"),
    fixed(V1, b"76").replace(b"text/plain 3", b"text/plain x"),
])
def test_broken_archives_are_refused(bad):
    with pytest.raises(arc.ArchiveError):
        list(arc.parse_arc(bad))


def test_dates():
    assert arc.warc_date("19970102030405") == "1997-01-02T03:04:05Z"
    assert arc.warc_date("19990101") == "1999-01-01T00:00:00Z"
    assert arc.warc_date("-") == "0001-01-01T00:00:00Z"


def sample():
    same, long = "<p>same ü</p>\r\n\r\nWARC/1.1\r\n", "x" * 300_000
    html = [same, None, "", same, long, "\n", "URL 1 2 3 4\nabc", same, long, "é\x85 ", "HTTP/1.0 200 OK\r\n\r\n"]
    rows = [(i, f"http://x/{i}" if i % 3 else None, h) for i, h in enumerate(html)]
    rows += [(100, "with space\nand line", same), (100, "with space\nand line", same), (None, None, same), (None, "http://x/n", "alone"), (101, "", "\r\n" * 3)]
    return rows


def expected(rows, least=0):
    best = {}
    for k, (i, _, h) in enumerate(rows):
        data = (h or "").encode()
        best[data] = max(best.get(data, (-1, -1)), (-1 if i is None else i, k))
    out = []
    for k, (i, _, h) in enumerate(rows):
        data = (h or "").encode()
        again = len(data) >= least and best[data][1] != k
        out.append((i, len(data), digest(data), "revisit" if again else "response", None if not again or best[data][0] < 0 else best[data][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 10])
def test_pages_come_back(spark, least):
    rows = sample()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).selectExpr("*", "'own' archive", "'own' record", "1 place")
    assert sorted((tuple(r) for r in arc.archived(df, min_bytes=least).collect()), key=str) == expected(rows, least)
    assert arc.archived(df.limit(0)).count() == 0


def test_archives_of_bounded_size_and_records(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i % 50}</p>" * 200) for i in range(400)] + [(1000, None, "y" * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    arcs, warcs = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    arc.write_arcs(df, arcs, archive_bytes=40_000)
    files = arc._files(spark, arcs).collect()
    texts = [gzip.decompress(bytes(f.content)) for f in files]
    assert len(files) > 10 and max(map(len, texts)) < 300_000
    assert {t.split(b"\n")[1].split(b" ")[0] for t in texts} == {b"1", b"2"}
    arc.convert(spark, arcs, warcs)
    names, targets = {}, []
    for f in arc._files(spark, warcs).collect():
        found = list(arc.parse_warc(bytes(f.content)))
        assert found[0][0]["warc-type"] == "warcinfo"
        for fields, block in found[1:]:
            assert fields["warc-warcinfo-id"] == found[0][0]["warc-record-id"] and fields["warc-date"] == "2000-01-01T00:00:00Z"
            names[fields["warc-record-id"]] = (fields["warc-type"], fields["warc-payload-digest"])
            if fields["warc-type"] == "revisit":
                assert block.endswith(b"\r\n\r\n") and fields["warc-profile"] == arc.REVISIT_PROFILE
                targets.append((fields["warc-refers-to"], fields["warc-payload-digest"]))
            else:
                assert "sha1:" + digest(block.partition(b"\r\n\r\n")[2]) == fields["warc-payload-digest"]
    assert len(names) == 401 and len(targets) == 350
    assert all(names[t] == ("response", d) for t, d in targets)  # every revisit names a response with its payload
    assert sorted((tuple(r) for r in arc.warc_records(spark, warcs).collect()), key=str) == expected(rows)
    assert {f.path.rsplit("/", 2)[1] for f in files} == {f.path.rsplit("/", 2)[1] for f in arc._files(spark, warcs).collect()}
