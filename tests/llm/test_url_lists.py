"""URL lists: histories, and captures as of their own time, against plain loops."""

import pytest

from dwelltide.llm import url_lists
from dwelltide.llm.url_lists import PERIOD, listed_captures, validity_intervals

ENTRIES = "list string, kind string, value string, action string, at long, extra string"
CAPTURES = "page_id long, url string, fetched_at long, value string, list string, blocked string"


def plain_intervals(entries):
    found = []
    for key in sorted({e[:3] for e in entries if None not in e[:5]}):
        changes = {}
        for e in entries:
            if e[:3] == key and e[3] in ("add", "remove") and e[4] is not None:
                changes[e[4]] = max(changes.get(e[4], ""), e[3])
        start = None
        for at in sorted(changes):
            if changes[at] == "add" and start is None:
                start = at
            elif changes[at] == "remove" and start is not None:
                found.append((*key, start, at))
                start = None
        if start is not None:
            found.append((*key, start, None))
    return found


def history():
    rows = [
        ("bad", "domain", "Example.com", "add", 100, "x"), ("bad", "domain", "Example.com", "remove", 200, "x"),
        ("bad", "domain", "Example.com", "add", 5 * PERIOD, "x"), ("bad", "domain", "Example.com", "add", 5 * PERIOD, "x"),
        ("bad", "url", "http://a.org/p", "add", 50, "x"), ("good", "domain", "www.example.com", "add", 150, "x"),
        ("good", "domain", "www.example.com", "remove", 160, "x"), ("bad", "domain", "org", "add", 10, "x"),
        ("bad", "domain", "org", "remove", 10, "x"), ("bad", "domain", "b.org", "other", 10, "x"),
        (None, "domain", "b.org", "add", 10, "x"), ("bad", "domain", None, "add", 10, "x"), ("bad", "domain", "b.org", "add", None, "x"),
        ("bad", "domain", "c.org", "remove", 5, "x"), ("bad", "domain", "c.org", "add", 7, "x"),
        ("bad", "domain", "a." * 300 + "org", "add", 0, "x"), ("bad", "url", "nothing", "add", -(10**18), "x"),
        ("bad", "url", "nothing", "remove", -5, "x"), ("bad", "domain", "ORG", "add", 9 * 10**12, "x"),
    ]
    return rows


def test_intervals(spark):
    rows = history()
    found = validity_intervals(spark.createDataFrame(rows, ENTRIES)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, plain_intervals(rows)))
    assert validity_intervals(spark.createDataFrame([], ENTRIES)).collect() == []


def plain_keys(url):
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = rest.replace("?", "/").replace("#", "/").split("/")[0].split("@")[-1].split(":")[0].lower().rstrip(".")
    labels = host.split(".")
    keys = [("domain", ".".join(labels[i:])) for i in range(len(labels))] if host else []
    return [*keys, ("url", url.split("#")[0])]


@pytest.mark.parametrize("rows_of_a_key", [100_000, 3])
def test_captures_meet_the_entries_of_their_time(spark, monkeypatch, rows_of_a_key):
    monkeypatch.setattr(url_lists, "KEY_ROWS", rows_of_a_key)
    urls = ["http://example.com/", "https://u@WWW.Example.com:80/x?y#z", "http://a.org/p#top", "http://a.org/p/", "http://b.c.org./",
            "nothing", "", "http:///x", "http://" + "a." * 40_000 + "org/"]
    times = [-(2**63), -9 * 10**17, -PERIOD, -1, 9 * 10**12, 9 * 10**17, 2**63 - 1, 0, 7, 99, 100, 150, 159, 160, 199, 200, 5 * PERIOD - 1, 5 * PERIOD, 9 * PERIOD]
    rows = [(n, u, t, "v", "l", "b") for n, (u, t) in enumerate((u, t) for u in urls for t in times)]
    rows += [rows[3], (None, urls[0], 100, "v", "l", "b"), (7, None, 100, "v", "l", "b"), (8, urls[0], None, "v", "l", "b")]
    rows += [(1000 + n, "http://x.example.com/", 150, "v", "l", "b") for n in range(200)]  # a hot key
    captures = spark.createDataFrame(rows, CAPTURES)
    found = listed_captures(captures, spark.createDataFrame(history(), ENTRIES), allow_lists=("good",))
    assert found.columns == ["page_id", "url", "fetched_at", "matches", "blocked"]
    expected = []
    for page_id, url, at, *_ in rows:
        active = []
        if url is not None and at is not None:
            keys = plain_keys(url)
            for name, kind, value, start, end in plain_intervals(history()):
                value = value.lower() if kind == "domain" else value
                if (kind, value) in keys and start <= at and (end is None or at < end):
                    active.append((name, f"{name}:{kind}:{value}"))
        blocked = any(n == "bad" for n, _ in active) and not any(n == "good" for n, _ in active)
        expected.append((page_id, url, at, sorted(m for _, m in active), blocked))
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in found.collect())
    empty = spark.createDataFrame([], ENTRIES)
    assert not any(r["blocked"] for r in listed_captures(captures, empty).collect())
    assert listed_captures(captures.limit(0), empty).collect() == []
