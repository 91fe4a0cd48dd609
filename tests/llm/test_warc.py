"""Archives: the index, byte-range reads, revisits, and the whole query against plain loops."""

import base64
import glob
import gzip
import hashlib

import pytest

from dwelltide.llm import warc

SCHEMA = "page_id long, url string, html string, file string, same string, payload string"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "f", "s", "p") for i, u, h in rows], SCHEMA)


def plain(rows, least=0):
    """What the records should say, by loops."""
    by_text = {}
    for i, _, html in rows:
        by_text.setdefault(html or "", []).append(i)
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        ids = [x for x in by_text[html or ""] if x is not None]
        first = max(ids) if ids and len(by_text[html or ""]) > 1 and len(payload) >= least else None
        refers = first if first is not None and first != i else None
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((i, len(payload), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def read_back(records):
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted(map(tuple, records.select(*columns).collect()), key=repr)


ROWS = [
    (1, "http://a/1", "same"), (5, "http://a/5", "same"), (3, None, "same"), (2, "http://b/", "other äöü"),
    (4, "http://c/x y\r\nWARC-Type: x", None), (6, "", ""), (None, "http://n/", "same"), (None, "n", "alone"),
    (None, "n", "none"), (None, "n", "none"), (7, "http://t/", "twice"), (7, "http://t/", "twice"), (8, "u", "twice again"),
    (9, "u", "\r\n\r\nWARC/1.1\r\n" * 5), (10, "u", "x" * 3_000_000), (-4, "u", "minus"), (-9, "u", "minus"),
]


@pytest.mark.parametrize("least", [0, 6])
def test_round_trip(spark, tmp_path, least):
    folder = str(tmp_path / "w")
    index = warc.write_archives(frame(spark, ROWS).repartition(3), folder, min_bytes=least)
    assert index.count() == len(ROWS)
    records = warc.read_records(index, folder)
    assert read_back(records) == plain(ROWS, least)
    texts = {(r["page_id"], bytes(r["payload"]).decode()) for r in records.filter("record_type = 'response'").collect()}
    assert {(i, h) for i, _, h in ROWS if i in (2, 8, 9, 10)} <= texts
    assert records.filter("record_type = 'revisit' AND payload IS NOT NULL").count() == 0
    one_line = records.filter("page_id = 4").first()["url"]
    assert one_line == "http://c/x%20y%0D%0AWARC-Type:%20x"


def test_archives_are_readable_as_a_whole(spark, tmp_path):
    folder = str(tmp_path / "w")
    warc.write_archives(frame(spark, ROWS).repartition(2), folder)
    data = b"".join(gzip.open(f).read() for f in glob.glob(f"{folder}/*.warc.gz"))
    # One page's text holds two lines like the start of a record.
    assert data.count(b"\r\nWARC-Record-ID: <urn:page:") == len(ROWS)


def test_chosen_records_only(spark, tmp_path):
    folder = str(tmp_path / "w")
    rows = [(i, f"http://h{i % 5}/{i}", f"page {i} " * 50) for i in range(200)]
    index = warc.write_archives(frame(spark, rows).coalesce(1), folder)
    for r in index.orderBy("offset").limit(40).collect():
        with open(f"{folder}/{r['file']}", "rb") as f:
            f.seek(r["offset"])
            assert warc.parse_record(gzip.decompress(f.read(r["length"])))["page_id"] == r["page_id"]
    # Damage all that is not asked for: the chosen records are read all the same.
    chosen = index.filter("url LIKE 'http://h3/%'")
    wanted = {(r["offset"], r["length"]) for r in chosen.collect()}
    path = f"{folder}/{index.first()['file']}"
    data = bytearray(open(path, "rb").read())
    spared = [False] * len(data)
    for offset, length in wanted:
        spared[offset : offset + length] = [True] * length
    open(path, "wb").write(bytes(b if s else 0 for b, s in zip(data, spared)))
    (tmp_path / "w" / f".{path.split('/')[-1]}.crc").unlink(missing_ok=True)
    assert sorted(r["page_id"] for r in warc.read_records(chosen, folder).collect()) == list(range(3, 200, 5))


def test_a_damaged_payload_is_found():
    data = warc.record(1, b"u", b"text", warc.base32_sha1(b"text"), None, "2024-01-01T00:00:00Z")
    assert warc.parse_record(data)["payload"] == b"text"
    for bad in (data.replace(b"text\r\n", b"tex!\r\n"), data[200:]):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


def test_reads_are_coalesced():
    near, far = warc.GAP_BYTES, warc.GAP_BYTES + 1
    places = [("a", 0, 10), ("a", 10, 10), ("a", 20 + near, 5), ("a", 25 + near + far, 5), ("b", 0, 9), ("b", 0, 9)]
    reads = list(warc.coalesced(places))
    assert [r[:3] for r in reads] == [("a", 0, 25 + near), ("a", 25 + near + far, 30 + near + far), ("b", 0, 9)]
    assert sum(len(r[3]) for r in reads) == len(places)
    long = list(warc.coalesced([("a", i << 20, 1 << 20) for i in range(20)]))
    assert all(end - start <= warc.READ_BYTES for _, start, end, _ in long) and len(long) == 3
    assert list(warc.coalesced([])) == [] and len(list(warc.coalesced([("a", 0, 1 << 30)]))) == 1


def test_many_files(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "w")
    rows = [(i, "u", f"{i * i}") for i in range(50)]
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1000)
    index = warc.write_archives(frame(spark, rows).coalesce(2), folder)
    assert read_back(warc.read_records(index, folder)) == plain(rows)


def test_empty_table(spark, tmp_path):
    index = warc.write_archives(frame(spark, []), str(tmp_path / "w"))
    assert warc.read_records(index, str(tmp_path / "w")).collect() == []


def test_payloads_of_many_pages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("dwelltide.llm.hot_keys.KEY_ROWS", 10)
    rows = [(i, "u", "hot" if i % 3 else f"pair {i // 6}") for i in range(90)]
    index = warc.write_archives(frame(spark, rows), str(tmp_path / "w"))
    assert read_back(warc.read_records(index, str(tmp_path / "w"))) == plain(rows)


def test_query_on_the_given_pages(spark, llm, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    found = llm["op13_web_archives"](spark, sf_dir)
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows)
