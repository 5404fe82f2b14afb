import glob
import gzip
import hashlib
import os
import time
import zlib

import pytest

from lakeload.llm import arc_convert as arc


def brute(rows, min_bytes=100):
    first = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    left = dict.fromkeys(h or "" for _, _, h in rows)  # one response of each payload
    out = []
    for p, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        h = h or ""
        b = h.encode()
        again = len(b) >= min_bytes and left[h]
        left[h] = True
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first.get(h) if again else None))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, path string, offset int")
    got = arc.pages_round_trip(df.repartition(3), **kw)
    return sorted((tuple(r)[:5] for r in got.collect()), key=str)


HTML = ["<p>é日本</p>" * 20, "x" * 99, "x" * 100, "", None, "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 5,
        "\nhttp://a 1 2 3 4\n" * 9, "HTTP/1.1 200 OK\r\n\r\n" * 9, "y" * 70_000, "\x00\x1f\x85 " * 40, "tail\n\n\n" * 20]


@pytest.mark.parametrize("target", [8 << 20, 3000])
def test_round_trip(spark, target):
    rows = [(i, f"http://h/{i} ä b", HTML[i % len(HTML)]) for i in range(60)]
    rows += [(None, None, "n" * 200), (None, "u", "n" * 200), (61, None, "n" * 200), (62, "\n", "z" * 200), (62, "\n", "z" * 200)]
    # large groups of copies, many small archives
    assert run(spark, rows, target=target) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


V1 = (
    b"filedesc://a.arc 0.0.0.0 19960923142103 text/plain 70\n1 0 Example\nURL IP-address Archive-date Content-type Archive-length\n\n\n\n"
    b"\nhttp://a b/ 10.0.0.1 19961104142103 text/html 25\nHTTP/1.0 200 OK\r\n\r\nhello\n\n"
    b"\ndns:x.org 10.0.0.1 19961104142103 text/dns 4\na\nbc\n"
)


def test_versions_and_declared_lengths():
    body = b"2 0 Example\n" + arc._FIELDS[2].encode() + b"\n\n"
    v2 = (
        b"filedesc://b.arc 0.0.0.0 20010101000000 text/plain 200 - - 0 b.arc %d\n%s" % (len(body), body)
        + b"\nhttp://x/ 1.2.3.4 20010203040506 text/html 200 abc - 99 b.arc 7\n\n\n\nabcd\n"
    )
    a, b = list(arc.arc_records(V1)), list(arc.arc_records(v2))
    assert [(r["url"], r["archive-date"], len(r["block"])) for r in a] == [
        ("filedesc://a.arc", "19960923142103", 70), ("http://a b/", "19961104142103", 25), ("dns:x.org", "19961104142103", 4)]
    assert a[1]["block"].endswith(b"hello\n") and b[1]["block"] == b"\n\n\nabcd" and b[1]["result-code"] == "200"
    with pytest.raises(ValueError, match="declares"):
        list(arc.arc_records(V1[:-3]))
    with pytest.raises(ValueError, match="does not end"):
        list(arc.arc_records(V1[:-8]))


def test_equivalent_warc_records():
    info, page, dns = (arc.convert(r, None) for r in arc.arc_records(V1))
    records = list(arc.warc_records(b"\r\n\r\n".join([info, page, dns]) + b"\r\n\r\n"))
    kinds = [h["warc-type"] for h, _ in records]
    assert kinds == ["warcinfo", "response", "resource"]
    h, block = records[1]
    assert h["warc-date"] == "1996-11-04T14:21:03Z" and h["warc-target-uri"] == "http://a b/" and block.endswith(b"hello\n")
    assert h["warc-payload-digest"] == "sha256:" + hashlib.sha256(b"hello\n").hexdigest()
    assert h["warc-record-id"].startswith("<urn:uuid:") and arc.convert(list(arc.arc_records(V1))[1], None) == page
    r = arc.convert(list(arc.arc_records(V1))[1], {"page": 3})
    (h, block), = arc.warc_records(r + b"\r\n\r\n")
    assert h["warc-type"] == "revisit" and block == b"HTTP/1.0 200 OK\r\n\r\n" and h["x-refers-to-page-id"] == "3"


def test_compressed_archives():
    assert arc._content(gzip.compress(V1)) == V1 == arc._content(V1)


def arc_file(*records, version=1):
    """(url, mime, block) as an archive of bytes."""
    out = arc.arc_head(version, "x.arc", "19990101000000").encode()
    for url, mime, block in records:
        out += f"\n{url} 1.2.3.4 19990102030405 {mime} {len(block)}\n".encode() + block
    return out


def test_archives_of_any_bytes(spark, tmp_base):
    http = b"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\n\r\n"
    latin, image = http + "Gr\u00fc\u00dfe aus K\u00f6ln ".encode("latin-1") * 20, http + bytes(range(256)) * 4
    packed = http + gzip.compress(b"compressed body " * 50)
    records = [("http://a/", "text/html", latin), ("http://b/", "image/png", image), ("http://c/", "text/html", packed), ("http://d/", "text/html", latin),
               ("http://e/", "text/plain", b""), ("dns:e", "text/dns", b"\xff\xfe\x00")]
    os.makedirs(f"{tmp_base}/arc")
    for name, data in (("plain.arc", arc_file(*records[:3])), ("packed.arc.gz", gzip.compress(arc_file(*records[3:])))):
        with open(f"{tmp_base}/arc/{name}", "wb") as f:
            f.write(data)
    arc.arc_to_warc(spark, f"{tmp_base}/arc", f"{tmp_base}/warc")
    got = {}
    for path in glob.glob(f"{tmp_base}/warc/part-*"):
        data = open(path, "rb").read()
        members = []
        while data:  # a member a record, and an empty one
            z = zlib.decompressobj(31)
            members.append(z.decompress(data) + z.flush())
            data = z.unused_data
        assert members[-1] == b"" and all(m.endswith(b"\r\n\r\n") for m in members[:-1])
        for m in members[:-1]:
            ((h, block),) = arc.warc_records(m)
            got[h.get("warc-target-uri")] = (h["warc-type"], block, h.get("warc-payload-digest"))
    sha = lambda b: "sha256:" + hashlib.sha256(b[len(http) :]).hexdigest()
    kinds = sorted((got["http://a/"][0], got["http://d/"][0]))
    assert kinds == ["response", "revisit"] and got["http://a/"][2] == got["http://d/"][2] == sha(latin)
    assert got["http://b/"][1:] == (image, sha(image)) and got["http://c/"][1:] == (packed, sha(packed))
    assert got["dns:e"][:2] == ("resource", b"\xff\xfe\x00") and got["http://e/"][1] == b""
    assert got["http://a/"][1] in (latin, http) and latin in (got["http://a/"][1], got["http://d/"][1])
    rows = {r.url: r.payload_bytes for r in arc.read_warc(spark, f"{tmp_base}/warc").collect() if r.record_type == "response"}
    assert rows["http://b/"] == 1024


def test_many_members_take_time_in_proportion():
    def seconds(n):
        data = b"".join([*(arc.member(os.urandom(2000)) for _ in range(n)), arc.LAST])
        began = time.process_time()
        assert len(arc._content(data)) == 2000 * n
        return time.process_time() - began

    one, four = seconds(1000), seconds(4000)
    assert four < 8 * one + 0.2


def test_members_padding_and_cut_archives():
    a, b = os.urandom(100_000), b"short"
    whole = arc.member(a) + arc.member(b"") + b"\0" * 700 + arc.member(b)
    assert arc._content(whole) == a + b == arc._content(whole + b"\0" * 9)
    for k in (1, 9, len(arc.member(b)) - 3):
        with pytest.raises(EOFError):
            arc._content(whole[:-k])
    with pytest.raises(zlib.error):
        arc._content(whole + b"no gzip")
