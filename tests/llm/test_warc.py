import gzip
import hashlib
import random

import pytest

from larder.llm import queries, warc


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [False, True])
def test_legacy_records_survive_both_versions(version, packed):
    contents = [b"", b"\n\nx\n", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody\r\n\r\n", "é日".encode() * 300, b"filedesc:// 1 2 3\n"]
    raw = warc.arc_version_block("a.arc", version, "20200102030405")
    for i, c in enumerate(contents):
        raw += warc.arc_record(version, f"http://x/ a b?{i}", "1.2.3.4", "20200102030405", "text/html", 200, c, len(raw), "a.arc")
    found = list(warc.read_arc(gzip.compress(raw) if packed else raw))
    assert [r["content"] for r in found] == contents
    assert [r["URL"] for r in found] == [f"http://x/%20a%20b?{i}" for i in range(len(contents))]
    if version == 2:
        assert [r["Checksum"] for r in found] == [hashlib.md5(c).hexdigest() for c in contents]


def test_blanks_in_urls_of_foreign_archives():
    body = b"1 0 Org\nURL IP-address Archive-date Content-type Archive-length\n"
    raw = b"filedesc://f 0.0.0.0 1996 text/plain %d\n" % len(body) + body + b"\nhttp://x/a b c 9.9.9.9 19961231235959 text/html 3\nabc\n"
    (record,) = warc.read_arc(raw)
    assert (record["URL"], record["IP-address"], record["content"]) == ("http://x/a b c", "9.9.9.9", b"abc")
    assert warc.warc_date(record["Archive-date"]) == "1996-12-31T23:59:59Z" and warc.warc_date("1996") == "1996-01-01T00:00:00Z"
    with pytest.raises(ValueError):
        list(warc.read_arc(raw[:-3]))
    with pytest.raises(ValueError):
        list(warc.read_arc(raw.replace(b"1 0 Org", b"3 0 Org")))


def slow(rows):
    first = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        if page is not None and len(payload) >= 100:
            first[payload] = min(first.get(payload, page), page)
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        origin = first.get(payload, page) if page is not None else None
        again = page is not None and origin != page
        out.append((page, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", origin if again else None))
    return sorted(out, key=str)


def _pages(rng):
    texts = ["", None, "x" * 99, "x" * 100, "é" * 50, "é" * 49, "line\r\n\r\nline" * 20, "WARC/1.1\r\n" * 30, "<p>long</p>" * 4000]
    rows = [(i * 3, rng.choice(["http://a", None, "http://b c\n"]), rng.choice(texts)) for i in range(120)]
    rows += [(None, "n", "x" * 100), (9, "again", "own " * 40), (9, "again", "own " * 40), (10, "copy", "own " * 40)]
    rng.shuffle(rows)
    return rows


def test_query_matches_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    rows = _pages(random.Random(1))
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op9_warc(spark, str(tmp_path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == slow(rows)


@pytest.mark.parametrize("version", [1, 2])
def test_archives_round_trip_whole_pages(spark, version):
    rows = _pages(random.Random(2))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc.convert(warc.write_arc(pages, version=version))
    found = warc.records(archives).collect()
    by_record = {r.record_id: r for r in found}
    html_of = {(p, hashlib.sha256((h or "").encode()).hexdigest()): h or "" for p, _, h in rows}
    for r in found:
        whole = r if r.record_type == "response" else by_record[r.refers_to_record]
        assert whole.record_type == "response" and whole.payload == html_of[r.page_id, r.payload_digest]
        assert r.date == "2020-01-01T00:00:00Z" and r.url in ("http://a", "-", "http://b%20c%0A", "n", "again", "copy")
    assert len(found) == len(rows)
    assert warc.records(warc.convert(warc.write_arc(pages.where("false")))).count() == 0
