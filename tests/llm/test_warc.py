import gzip
from collections import Counter

from llm.brute import sha

from reviewlake.llm.warc import (
    FIELDS, archived, convert, http_message, parse_arc, parse_warc, read_arc, read_warc, timestamp, unpacked,
)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, record string, digest int")


def test_awkward_pages(spark):
    long = "<p>" + "ü" * 60 + "\r\n\r\nWARC/1.0\r\n" + "</p>"
    rows = [(3, "http://a", long, None, 1), (1, "http://b c\n", long, "x", None), (2, None, None, None, None),
            (4, "http://d", "", None, 1), (5, "u", "short", None, 1), (6, "u", "short", None, 1), (1, "http://e", long, None, 1),
            (None, "http://f", long, None, 1), (7, "http://g", "y" * 300_000, None, 2)]
    got = Counter(tuple(r)[:5] for r in archived(pages(spark, rows)).collect())
    size, digest = len(long.encode()), sha(long.encode())
    want = Counter({(7, 300_000, sha(b"y" * 300_000), "response", None): 1, (2, 0, sha(b""), "response", None): 1,
                    (4, 0, sha(b""), "response", None): 1, (5, 5, sha(b"short"), "response", None): 1,
                    (6, 5, sha(b"short"), "response", None): 1, (1, size, digest, "response", None): 1,
                    (1, size, digest, "revisit", 1): 1, (3, size, digest, "revisit", 1): 1,
                    (None, size, digest, "revisit", 1): 1})
    assert got == want
    assert archived(pages(spark, [])).count() == 0


def arc(version, records, declared=None):
    first = f"{version} 0 test\n{FIELDS[version]}\n".encode()
    extra = "200 - - 0 f " if version == 2 else ""
    out = f"filedesc://f 0.0.0.0 20010203040506 text/plain {extra}{len(first)}\n".encode() + first + b"\n"
    for url, mime, block in records:
        out += f"{url} 1.2.3.4 20010203040506 {mime} {extra}{declared or len(block)}\n".encode() + block + b"\n"
    return out


def test_both_versions_and_binary_blocks():
    blocks = [("http://a/x y", "text/html", http_message(b"\x00\xff\n\n", 5)), ("dns:a", "text/dns", b"1.2.3.4\n")]
    for version in (1, 2):
        found = list(parse_arc(arc(version, blocks)))
        assert [b for _, _, b in found[1:]] == [b for _, _, b in blocks]
        assert [f["URL"] for _, f, _ in found[1:]] == ["http://a/x y", "dns:a"]


def test_lengths_beyond_the_end_are_reported():
    found = list(parse_arc(arc(1, [("u", "text/html", b"abc")], declared=999)))
    assert found[0][1] is not None and found[1][1] is None and len(found) == 2


def test_gzip_members_and_timestamps():
    assert unpacked(gzip.compress(b"ab") + gzip.compress(b"cd")) == b"abcd"
    assert timestamp("20010203040506") == "2001-02-03T04:05:06Z"
    assert timestamp("200102") == "2001-02-01T00:00:00Z"
    assert timestamp("never") == "1970-01-01T00:00:00Z"


def test_foreign_archives(spark, tmp_path):
    (tmp_path / "arc").mkdir()
    payload = b"\xfe\xff" * 80
    (tmp_path / "arc" / "one.arc").write_bytes(arc(1, [("http://a", "text/html", http_message(payload, None)),
                                                       ("dns:a", "text/dns", b"1.2.3.4")]))
    (tmp_path / "arc" / "two.arc.gz").write_bytes(gzip.compress(arc(2, [("http://b", "text/html", http_message(payload, None))])))
    (tmp_path / "arc" / "bad.arc").write_bytes(arc(1, [("u", "text/html", b"abc")], declared=999))
    src, out = f"file://{tmp_path}/arc", f"file://{tmp_path}/warc"
    assert read_arc(spark, src).where("error is not null").count() == 1
    convert(spark, src, out)
    rows = {(r["url"], r["record_type"], r["payload_digest"]) for r in read_warc(spark, out).collect()}
    assert rows == {("http://a", "response", sha(payload)), ("dns:a", "resource", sha(b"1.2.3.4")),
                    ("http://b", "revisit", sha(payload))}
    fields = [f for p in (tmp_path / "warc").glob("part-*") for f, _ in parse_warc(unpacked(p.read_bytes()))]
    assert len({f["warc-record-id"] for f in fields}) == len(fields) == 6
    assert {f["warc-date"] for f in fields} == {"2001-02-03T04:05:06Z"}
