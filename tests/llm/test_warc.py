import base64
import gzip
import hashlib

import pytest

from recflow.llm import warc

ROWS = [(5, "http://a.b/c d", "same"), (3, "http://x.y", "same"), (9, None, None), (2, "http://e", ""), (7, "ftp://z", "über\r\n\r\nalles"),
        (None, "http://n", "same"), (4, "http://dup", "dup"), (4, "http://dup", "dup"), (11, "http:x", "long " * 30_000)]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id long, url string, html string, offset string, digest int")


def brute(rows, least=0):
    out, first = [], {}
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        if len(body) < least or digest not in first:
            first.setdefault(digest, i)
            out.append((i, len(body), digest, "response", None))
        else:
            out.append((i, len(body), digest, "revisit", first[digest]))
    return sorted(out, key=str)


@pytest.mark.parametrize("version,least", [(1, 0), (2, 0), (1, 4), (2, 10**6)])
def test_round_trip(spark, version, least):
    got = warc.archive(pages(spark), version, least).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(ROWS, least)


def test_empty_table(spark):
    assert warc.archive(pages(spark, [])).count() == 0


def test_record_ids_resolve(spark):
    got = warc.archive(pages(spark)).collect()
    by_id = {r["record_id"]: r for r in got}
    assert len(by_id) == len(got)
    for r in got:
        if r["record_type"] == "revisit":
            target = by_id[r["refers_to_record"]]
            assert target["payload_digest"] == r["payload_digest"] and target["record_type"] == "response"
            assert target["page_id"] == r["refers_to"]
        assert r["date"] == "2024-01-01T00:00:00Z"


def test_header_lines_by_version():
    v1 = b"http://a.b/x y 10.0.0.1 19990102030405 text/html 5\nhello\n"
    fields, content = warc.parse_arc_record(v1, 1)
    assert fields["url"] == "http://a.b/x y" and content == b"hello" and warc.iso_date(fields["date"]) == "1999-01-02T03:04:05Z"
    v2 = b"http://a.b/ 10.0.0.1 19990102030405 text/html 200 abc - 77 f.arc 3\nabcdef"
    fields, content = warc.parse_arc_record(v2, 2)
    assert (fields["result"], fields["offset"], fields["filename"], content) == ("200", "77", "f.arc", b"abc")
    with pytest.raises(ValueError):
        warc.parse_arc_record(b"http://a 1 2 text/html 50\nshort", 1)
    with pytest.raises(ValueError):
        warc.parse_arc_line(b"too few fields", 2)
    for version in (1, 2):
        assert warc.arc_version(warc.arc_file_head(version, "n")) == version


def test_record_types():
    filedesc = warc.convert_record("f", 0, {"url": "filedesc://f", "ip": "0", "date": "2024"}, b"x", None)
    dns = warc.convert_record("f", 9, {"url": "dns:a", "ip": "0", "date": "20240102", "type": "text/dns"}, b"x", None)
    assert warc.parse_warc_record(filedesc)[0]["warc-type"] == "warcinfo"
    fields, block = warc.parse_warc_record(dns)
    assert fields["warc-type"] == "resource" and block == b"x" and fields["warc-date"] == "2024-01-02T00:00:00Z"


def test_files_are_gzip_members(spark, tmp_path):
    index = warc.write_arc(pages(spark), str(tmp_path)).collect()
    for r in index:
        with open(tmp_path / r["arc"], "rb") as f:
            f.seek(r["offset"])
            assert gzip.decompress(f.read(r["record_bytes"])).endswith(b"\n")


HTTP = b"HTTP/1.0 200 OK\nServer: old\nX-Page-Id: none\n\n"
MIXED = (b"filedesc://old.arc 0.0.0.0 19970102030405 text/plain 77\n1 0 Alexa\n"
         b"URL IP-address Archive-date Content-type Archive-length\nabcdefghij\n")
BODIES = [b"http://a.b/x y 10.0.0.1 19990102030405 text/html %d\n" % (len(HTTP) + 5) + HTTP + b"hello\n",
          b"dns:a.b 10.0.0.1 19990102030406 text/dns 9\n1999 A 1\n\n",
          b"\n\nhttp://c.d/ 10.0.0.2 19990102030407 text/html %d\n" % (len(HTTP) + 5) + HTTP + b"hello\n",
          b"http://e.f/ 10.0.0.3 1999010203 text/plain 4\n\n\xff\n\n\n",
          b"filedesc://x 10.0.0.3 19990102030408 text/html %d\n" % (len(HTTP) + 14) + HTTP + b"WARC/1.0\r\n\r\n\r\n\n"]


def foreign(folder):
    """The same records as a plain file, one member, a member per record, and two members that cut records."""
    whole = MIXED + b"".join(BODIES)
    forms = {"plain.arc": whole, "one.arc.gz": gzip.compress(whole), "cut.gz": gzip.compress(whole[:300]) + gzip.compress(whole[300:]),
             "each.arc.gz": b"".join(gzip.compress(r) for r in [MIXED, *BODIES])}
    for name, data in forms.items():
        (folder / name).write_bytes(data)
    return whole, forms


def test_archives_from_elsewhere(spark, tmp_path):
    """Files without an index: every form gives the same records, whose places are those in the plain bytes."""
    whole, forms = foreign(tmp_path)
    found = warc.scan_arc(warc.archive_files(spark, str(tmp_path)), str(tmp_path)).collect()
    for name in forms:
        rows = sorted((r for r in found if r["arc"] == name), key=lambda r: r["offset"])
        assert [r["kind"] for r in rows] == ["response", "resource", "response", "resource", "response"]
        assert [r["target_uri"] for r in rows] == ["http://a.b/x y", "dns:a.b", "http://c.d/", "http://e.f/", "filedesc://x"]
        assert all(whole[r["offset"]:].startswith(r["target_uri"].encode()) for r in rows)
        assert [r["payload_bytes"] for r in rows] == [5, 9, 5, 4, 14] and rows[3]["date"] == "1999-01-02T03:00:00Z"
        assert rows[0]["digest"] == base64.b32encode(hashlib.sha1(b"hello").digest()).decode()
        assert all(r["fault"] is None and r["page_id"] is None for r in rows)


def test_converting_archives_from_elsewhere(spark, tmp_path):
    arcs, warcs = tmp_path / "arcs", tmp_path / "warcs"
    arcs.mkdir()
    _, forms = foreign(arcs)
    got = warc.convert_folder(spark, str(arcs), str(warcs)).collect()
    kinds = sorted(r["record_type"] for r in got)
    # two payloads, one response each; everything else with an HTTP head refers to it
    assert kinds == ["resource"] * 8 + ["response"] * 2 + ["revisit"] * 10 and len({r["record_id"] for r in got}) == 20
    by_id = {r["record_id"]: r for r in got}
    for r in got:
        assert r["payload_bytes"] == {"http://a.b/x y": 5, "http://c.d/": 5, "dns:a.b": 9, "http://e.f/": 4,
                                      "filedesc://x": 14}[r["target_uri"]]
        if r["record_type"] == "revisit":
            assert by_id[r["refers_to_record"]]["payload_digest"] == r["payload_digest"]


def test_fields_as_declared_and_version_2(spark, tmp_path):
    body = b"1 0 me\nURL Archive-date IP-address Result-code Content-type Archive-length\n"
    own = b"filedesc://o.arc 0.0.0.0 19970102030405 text/plain %d\n" % len(body) + body + b"\n"
    (tmp_path / "order.arc").write_bytes(own + b"http://a/ 19990102030405 1.2.3.4 404 text/html 2\nab\n")
    (tmp_path / "two.arc").write_bytes(warc.arc_file_head(2, "two.arc") + warc.arc_record(2, "two.arc", 9, "http://b/", b"abc"))
    rows = warc.scan_arc(warc.archive_files(spark, str(tmp_path)), str(tmp_path)).collect()
    assert {(r["arc"], r["target_uri"], r["date"], r["payload_bytes"]) for r in rows} == {
        ("order.arc", "http://a/", "1999-01-02T03:04:05Z", 2), ("two.arc", "http://b/", "2024-01-01T00:00:00Z", 3)}


def test_damaged_files(spark, tmp_path):
    """Records before the damage are given and converted; the rest is a row with the fault."""
    arcs = tmp_path / "arcs"
    arcs.mkdir()
    whole = MIXED + b"".join(BODIES)
    (arcs / "short.arc").write_bytes(whole[:-10])
    (arcs / "short.arc.gz").write_bytes(gzip.compress(whole)[:-30])
    (arcs / "lines.arc").write_bytes(MIXED + BODIES[0] + b"no header line\n" + BODIES[1])
    (arcs / "headless.arc").write_bytes(BODIES[0])
    (arcs / "empty.arc").write_bytes(b"")
    rows = warc.scan_arc(warc.archive_files(spark, str(arcs), ".arc"), str(arcs)).collect()
    sound = {n: [r["target_uri"] for r in rows if r["arc"] == n and r["kind"]] for n in ("short.arc", "lines.arc", "headless.arc", "empty.arc")}
    assert [len(v) for v in sound.values()] == [4, 1, 0, 0]
    assert sorted(r["arc"] for r in rows if r["fault"]) == ["headless.arc", "lines.arc", "short.arc"]
    got = warc.convert_folder(spark, str(arcs), str(tmp_path / "warcs")).collect()
    assert sum(r["target_uri"] == "dns:a.b" for r in got) >= 1 and sum(r["target_uri"] == "http://a.b/x y" for r in got) >= 2


def test_awkward_urls_and_many_copies(spark):
    """Urls that look like an archive's own or dns records, a very long one, and one payload in most rows."""
    rows = [(1, "dns:a", "x"), (2, "filedesc://b", "x"), (3, "http://c/" + "u" * 2_000_000, "y"), (4, "", "\n\nHTTP/1.1 200\n\n")]
    rows += [(10 + i, "http://d", "") for i in range(600)] + [(None, None, None)] * 3
    got = warc.archive(pages(spark, rows)).collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got),
                  key=str) == brute(rows)
    assert max(len(r["target_uri"]) for r in got) == 2_000_009
