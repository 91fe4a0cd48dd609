"""Fingerprints and classes against plain loops."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from dwelltide.llm.components import connected_components
from dwelltide.llm.simhash import hex_fingerprint, near_duplicates, near_links, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_simhash(text, n=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                parent[top(a)] = top(b)
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize(
    "text",
    [None, "", " \t\n", "One", " one  Two\x0b", "a b c", "A b\nC d\r\ne", "É é Ä x y z w", "x " * 70_000],
)
def test_fingerprint(text):
    assert simhash(text) == plain_simhash(text)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("max_bits", [1, 2, 3])
@pytest.mark.parametrize("compared", [32_768, 3])
def test_links_join_what_all_pairs_join(spark, max_bits, compared):
    rng = random.Random(max_bits)
    prints = {rng.getrandbits(64) for _ in range(60)} | {0, 1, 3, (1 << 64) - 1}
    for p in list(prints)[:25]:
        for _ in range(6):
            for _ in range(rng.randint(1, 4)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    rows = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint long")
    links = near_links(rows, max_bits, compared).collect()
    for a, b in links:
        assert ((a ^ b) & ((1 << 64) - 1)).bit_count() <= max_bits
    linked = {(a, b) for a, b in links} | {(b, a) for a, b in links}
    ours = roots(sorted(map(signed, prints)), lambda a, b: (a, b) in linked)
    theirs = roots(
        sorted(map(signed, prints)), lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= max_bits
    )
    groups = lambda r: {frozenset(n for n in r if r[n] == t) for t in set(r.values())}
    assert groups(ours) == groups(theirs)
    if compared == 32_768:
        assert len(links) <= 3 * len(prints)


def test_chains_stars_and_circles_are_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)]
    links += [(200, 201), (201, 202), (202, 200), (300, 300), (None, 5)]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    groups = {}
    for node, root in found:
        groups.setdefault(root, set()).add(node)
    assert sorted(map(sorted, groups.values())) == [list(range(41)), list(range(100, 140)), [200, 201, 202]]
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_classes_of_documents(spark):
    base = " ".join(f"w{i * i % 97}" for i in range(400))
    near = base.replace("w64", "w65", 1)
    rows = [
        (5, base), (3, base), (9, near), (1, "something else than that"), (7, None), (8, ""), (2, " "),
        (4, "SOMETHING else than that"), (4, "SOMETHING else than that"), (None, base), (None, "only unknown"),
    ]
    docs = spark.createDataFrame([(i, t, "f", 1) for i, t in rows], "doc_id long, text string, fingerprint string, component int")
    found = near_duplicates(docs).select("doc_id", hex_fingerprint().alias("hex"), "fingerprint", "component", "stays", "copies").collect()
    assert len(found) == len(rows)
    top = roots(range(len(rows)), lambda a, b: (plain_simhash(rows[a][1]) ^ plain_simhash(rows[b][1])).bit_count() <= 2)
    expected = []
    for n, (i, text) in enumerate(rows):
        members = [rows[m][0] for m in top if top[m] == top[n] and rows[m][0] is not None]
        expected.append((i, f"{plain_simhash(text):016x}", min(members, default=None)))
    assert sorted(map(repr, expected)) == sorted(repr((r["doc_id"], r["hex"], r["component"])) for r in found)
    for r in found:
        assert r["stays"] == (r["doc_id"] == r["component"])
    assert {r["copies"] for r in found if r["component"] == 1} == {1}
    assert near_duplicates(docs.limit(0)).collect() == []


def test_query_is_that_of_plain_loops(spark, sf_dir, llm):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    prints = {i: plain_simhash(t) for i, t in docs.items()}
    top = roots(sorted(docs), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    smallest = {t: min(i for i in top if top[i] == t) for t in set(top.values())}
    found = llm["op8_simhash_classes"](spark, sf_dir).collect()
    assert {tuple(r) for r in found} == {(i, f"{prints[i]:016x}", smallest[top[i]]) for i in docs}
    assert len(found) == len(docs)


def test_segments_of_a_ring_meet_in_the_jvm(spark):
    rows = spark.range(1).select(F.lit(-1).cast("long").alias("fingerprint"))
    assert near_links(rows, 0).collect() == []
