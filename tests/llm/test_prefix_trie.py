"""The trie against plain loops, with conversations over many partitions; its sketch on its own."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dwelltide.llm import prefix_trie as P
from dwelltide.session import settings

SCHEMA = "conv_id long, turn long, role string, text string, a long, depth string, kind string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "d", "k") for r in rows], SCHEMA)


def truncated(c):
    return c - (abs(c) % 100) * (1 if c >= 0 else -1)


def crc_head(c):
    return zlib.crc32(str(c).encode()) % 6


def plain(rows, base=truncated, head=crc_head):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, name, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = head(c)
        built[c] = own.get(base(c), [])[:h] + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    below = {}
    for path in members:
        if path:
            below.setdefault(path[:-1], []).append(path)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for path, held in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in below
            saved[path[:d]] += (len(held) - 1) * len(path[-1][1]) if path else 0
    out = []
    for path, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(built[c]) == len(path))
        out.append((
            min(held), len(path), min(members[path[:-1]]) if path else None, len(held), len(below.get(path, [])),
            leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def rows_of(seed, convs=130):
    rng = np.random.default_rng(seed)
    words = ["hello", "what?", "äöü €", "", "𝕏 and more", None, "fine"]
    rows = []
    for c in [*range(convs), -1, -7, -150, -100, 905, 1003, 2**40]:
        if c == 100:
            continue  # a base that is not there
        first = [(0, "system", "You help."), (1, "user", words[rng.integers(3)])] if c % 3 else []
        more = int(rng.integers(0, 9)) if c % 17 else 60
        turns = first + [(i + 2, "user" if i % 2 else None, words[rng.integers(len(words))]) for i in range(more)]
        turns = turns or [(None, None, None)]
        rows += [(c, *t) for t in turns]
    rows += [(3, None, "x", "null turns come first"), (3, None, "w", "two of them"), (3, 4, "a", "tie"), (3, 4, "a", "tie"), (None, 1, "u", "no id")]
    rows += [(c, i, "user", f"the same {i}") for c in (50, 51, 52, 53, 350) for i in range(100, 140)]
    return rows


ALONE = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.mark.parametrize("partitions,cells", [("3", 1 << 24), ("29", 1 << 24), ("200", 1 << 24), ("29", 16)])
def test_as_by_loops(spark, monkeypatch, partitions, cells):
    rows = rows_of(1)
    # A sketch of sixteen cells proves nothing, and all is grouped.
    monkeypatch.setattr(P, "CELLS", (min(cells, 1 << 12), cells))
    monkeypatch.setattr(P, "STRIDE", 16)
    monkeypatch.setattr(P, "BLOB_IDS", 3)
    with settings(spark, {**ALONE, "spark.sql.shuffle.partitions": partitions}):
        own = F.col("conv_id")
        found = P.prefix_trie(frame(spark, rows).repartition(5), own - own % 100, F.crc32(own.cast("string")) % 6, max_head=5)
        assert sorted(map(tuple, found.collect()), key=repr) == plain(rows)


def test_as_they_are(spark):
    rows = rows_of(2, 40)
    with settings(spark, {**ALONE, "spark.sql.shuffle.partitions": "11"}):
        found = P.prefix_trie(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=repr) == plain(rows, base=lambda c: c, head=lambda c: 0)


def test_one_conversation_over_all_partitions(spark):
    rows = [(200, i, "u", "first" if i < 2 else f"t{i}") for i in range(300)] + [(207, i, "u", f"t{i}") for i in range(400)]
    rows += [(1, 0, "u", "alone")]
    with settings(spark, {**ALONE, "spark.sql.shuffle.partitions": "17"}):
        own = F.col("conv_id")
        found = P.prefix_trie(frame(spark, rows), own - own % 100, F.when(own == 207, 300).otherwise(0), max_head=300).collect()
    expected = plain(rows, head=lambda c: 300 if c == 207 else 0)
    assert sorted(map(tuple, found), key=repr) == expected


def test_copies_of_a_conversation(spark, monkeypatch):
    monkeypatch.setattr("dwelltide.llm.hot_keys.KEY_ROWS", 10)
    rows = [(c, i, "u", f"turn {i}" if c < 200 or i < 2 else f"turn {i} of {c}") for c in range(300) for i in range(4)]
    found = P.prefix_trie(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=repr) == plain(rows, base=lambda c: c, head=lambda c: 0)


def test_few_and_no_rows(spark):
    assert P.prefix_trie(frame(spark, [])).collect() == []
    assert P.prefix_trie(frame(spark, [(None, 1, "u", "t")])).collect() == []
    one = P.prefix_trie(frame(spark, [(7, 1, "u", "t")])).collect()
    assert sorted(map(tuple, one), key=repr) == plain([(7, 1, "u", "t")], base=lambda c: c, head=lambda c: 0)
    own = F.col("conv_id")
    bare = P.prefix_trie(frame(spark, [(7, 1, "u", "t"), (8, 1, "u", "t")]), own - own % 100, F.lit(3)).collect()
    assert [tuple(r)[:7] for r in bare] == [(7, 0, None, 2, 0, 1, 0)]
    with pytest.raises(Exception, match="max_head=2"):
        P.prefix_trie(frame(spark, [(7, 1, "u", "t")]), own, F.lit(3), max_head=2).collect()


def test_sketch_counts_never_too_few(spark):
    rng = np.random.default_rng(3)
    a = np.concatenate([rng.integers(0, 1 << 62, 3000), rng.integers(0, 1 << 62, 50).repeat(2)])
    b = -a * 31
    rows = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)], "a long, b long").repartition(7)
    for bits, least in ((16, 0.95), (8, 0)):
        shared = P.may_be_shared(P.count_min(rows, bits), a, b)
        assert shared[3000:].all()
        assert (~shared[:3000]).mean() >= least


def test_query_matches_sql(spark, sf_dir, llm, duck):
    import __spark_entry__ as entry_module

    found = llm["op12_prefix_trie"](spark, sf_dir)
    expected = duck.sql(entry_module.oracle_sql()["op12_prefix_trie"])
    assert sorted(found.columns) == sorted(expected.columns)
    rows = sorted(map(repr, map(tuple, found.select(*expected.columns).collect())))
    assert rows and rows == sorted(map(repr, expected.fetchall()))
