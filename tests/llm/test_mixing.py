"""Source mixing: targets, exact quotas, whole passes and the tree."""

import dataclasses
import re

import pytest
from pyspark.sql import functions as F

from dwelltide.llm import mixing as M
from dwelltide.llm.mixing import mixed, plan_mix, ranked_weights, taken_words, targets
from dwelltide.session import settings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, size string, shard string, key int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y", 1) for i, t, s in rows], SCHEMA)


def plain_targets(sizes, weights, share, ceiling):
    """Rounds of sharing out, as long as one is above its stop."""
    left, stopped, got = share * sum(sizes.values()), set(), dict.fromkeys(sizes, 0.0)
    while True:
        free = [s for s in sizes if s not in stopped]
        total = sum(weights[s] for s in free)
        if not total:
            return got
        rest = left - sum(got[s] for s in stopped)
        for s in free:
            got[s] = rest * weights[s] / total
        above = [s for s in free if got[s] > ceiling * sizes[s]]
        if not above:
            return got
        for s in above:
            got[s] = ceiling * sizes[s]
            stopped.add(s)


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 90, "c": 5, None: 70}, {"a": 10, "b": 1, "c": 1000, "d": 0}, {"a": 0}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = targets(rows, ranked_weights(rows), 1.5, 2.0).collect()
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    expected = plain_targets(sizes, weights, 1.5, 2.0)
    assert {r["source"]: round(r["target"], 6) for r in found} == {s: round(t, 6) for s, t in expected.items()}


def many(spark):
    rows = [(i, "w " * (i * 7 % 50), f"s{i % 4}" if i % 4 else None) for i in range(1, 300)]
    rows += [(1000 + i, "a b\tc", "s1") for i in range(300)]  # a hot source
    rows += [(7, "x y z", "s2")] * 3 + [(None, "n n", "s2"), (2000, None, "s3"), (2001, "", "s3"), (2002, "v " * 4000, "s3")]
    return docs(spark, rows), rows


def test_what_is_taken_meets_the_target(spark):
    frame, rows = many(spark)
    mix = plan_mix(frame, shards=5, blocks_per_shard=8)
    found = taken_words(mix).collect()
    assert len(found) == len(rows)
    by_target = {}
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"]
        entry = by_target.setdefault((r["target"], r["source_size"]), [0])
        entry[0] += r["taken"]
    for (target, size), (taken,) in by_target.items():
        assert abs(taken - target) <= 0.5 and target <= 2 * size
    again = taken_words(plan_mix(frame.repartition(5), shards=5, blocks_per_shard=8)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))


def test_the_mix_holds_what_is_taken(spark):
    frame, rows = many(spark)
    mix = plan_mix(frame, shards=5, blocks_per_shard=8)
    taken, got = {}, {}
    for r in taken_words(mix).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    out = mixed(frame, mix, "in_shard")
    assert out.columns == [*frame.columns, "in_shard"]
    for r in out.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(WORD.findall(r["text"]))
        assert 0 <= r["in_shard"] < 5
    assert got == {i: n for i, n in taken.items() if n}


def test_the_tree_deals_every_block_once_and_evenly(spark):
    mix = plan_mix(many(spark)[0], shards=5, blocks_per_shard=8)
    units = mix.units.collect()
    assert len({(u["source"], u["pass"], u["block"]) for u in units}) == len(units)
    sizes = [sum(u["shard"] == s for u in units) for s in range(5)]
    assert sum(sizes) == len(units) and max(sizes) - min(sizes) <= 3
    assert any(u["pass"] == 2 for u in units)


def test_no_words_no_rows_own_weights(spark):
    assert taken_words(plan_mix(docs(spark, []))).collect() == []
    found = taken_words(plan_mix(docs(spark, [(1, None, "a"), (2, " ", None)]))).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in found] == [(0, 0.0, 0)] * 2
    weights = spark.createDataFrame([("a", 1.0)], "source string, weight double")
    rows = [(i, "x y", "a") for i in range(10)] + [(20 + i, "x y", "b") for i in range(10)]
    found = taken_words(plan_mix(docs(spark, rows), weights, share=0.25)).collect()
    assert sum(r["taken"] for r in found if r["doc_id"] < 20) == 10
    assert sum(r["taken"] for r in found if r["doc_id"] >= 20) == 0


@pytest.mark.parametrize("few", [10_000, 0])
def test_rows_of_one_id_meet_the_target(spark, monkeypatch, few):
    monkeypatch.setattr(M, "FEW_ROWS", few)
    monkeypatch.setattr(M, "PART_BITS", 30)
    same = [(None, "w", "a")] * 1000
    found = taken_words(plan_mix(docs(spark, same), shards=4, blocks_per_shard=4)).collect()
    assert sum(r["taken"] for r in found) == 1500 and {r["taken"] for r in found} == {1, 2}
    texts = [(None, f"w{i % 7} x y z", "a" if i % 3 else None) for i in range(900)] + [(5, "u v", "b")] * 40
    frame = docs(spark, texts)
    mix = plan_mix(frame, shards=4, blocks_per_shard=4)
    found = taken_words(mix).collect()
    for target in {r["target"] for r in found}:
        rows = [r for r in found if r["target"] == target]
        assert abs(sum(r["taken"] for r in rows) - target) <= 0.5
        # All but one are taken whole, once or more often.
        assert sum(r["taken"] % r["size"] > 0 for r in rows) <= 1
    assert mixed(frame, mix).count() == sum(-(-r["taken"] // r["size"]) for r in found)


def test_shuffled_reruns_agree(spark):
    frame, _ = many(spark)
    first = None
    for n in range(1, 11):
        rows = frame.orderBy(F.rand(n)).repartition(n)
        found = sorted(map(repr, taken_words(plan_mix(rows, shards=2, blocks_per_shard=8)).collect()))
        first = first or found
        assert found == first


def test_the_tree_decides_what_is_taken(spark):
    frame, _ = many(spark)
    mix = plan_mix(frame, shards=5, blocks_per_shard=8)
    words = lambda m: taken_words(m).agg(F.sum("taken")).first()[0]
    parts = [words(dataclasses.replace(mix, units=mix.units.filter(F.col("shard") == i))) for i in range(5)]
    assert sum(parts) == words(mix) and min(parts) > 0


def test_native(spark):
    frame, _ = many(spark)
    mix = plan_mix(frame)
    for rows in (taken_words(mix), mixed(frame, mix)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_query_matches_sql(spark, sf_dir, llm, duck):
    import __spark_entry__ as entry_module

    for name in ("op1_nearest_neighbours", "op2_url_lists", "op3_source_mix", "op5_top_scores"):
        found = llm[name](spark, sf_dir)
        expected = duck.sql(entry_module.oracle_sql()[name])
        columns = sorted(found.columns)
        assert sorted(expected.columns) == columns
        theirs = [tuple(r[expected.columns.index(c)] for c in columns) for r in expected.fetchall()]
        assert sorted(map(repr, theirs)) == sorted(repr(tuple(r)) for r in found.select(columns).collect())


def test_extra_copies_are_whole_but_for_the_last(spark):
    rows = [(i, f"a{i} b{i} c{i}", "s") for i in range(50)]
    out = mixed(docs(spark, rows), plan_mix(docs(spark, rows)))
    texts = [r["text"] for r in out.collect()]
    whole = [t for t in texts if len(t.split()) == 3]
    assert len(texts) - len(whole) <= 1 and sum(len(t.split()) for t in texts) == 225
    assert out.filter(F.col("size") != "x").count() == 0


def test_a_large_shard_goes_to_several_tasks_in_order(spark, monkeypatch):
    from dwelltide.llm import mixing

    monkeypatch.setattr(mixing, "WORDS_PER_TASK", 50)
    frame, _ = many(spark)
    mix = plan_mix(frame, shards=2, blocks_per_shard=8)
    assert mix.tasks_per_shard > 20
    out = mixed(frame, mix, "in_shard").withColumn("task", F.spark_partition_id())
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):  # else few rows share a task
        tasks = out.groupBy("in_shard").agg(F.countDistinct("task").alias("n")).collect()
    assert all(r["n"] > 1 for r in tasks)
    assert out.count() == mixed(frame, plan_mix(frame, shards=2, blocks_per_shard=8)).count()


@pytest.mark.parametrize("rows", [
    [(None, f"a{i} b{i} c{i} d{i}", "s") for i in range(80)],
    [(9, f"a{i}", "s") for i in range(60)] + [(None, "a b c", "t")] * 81,
    [(None, "same words here", None)] * 70 + [(i, "x y z v w", None) for i in range(5)] + [(4, "q r", "u")],
])
def test_rows_of_one_id_are_taken_whole_but_one(spark, monkeypatch, rows):
    from dwelltide.llm import mixing

    monkeypatch.setattr(mixing, "COPIES_AT_ONCE", 20)
    frame = docs(spark, rows)
    sizes, weights = {}, {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    for i, source in enumerate(sorted(sizes, key=lambda s: (s is None, s or ""))):
        weights[source] = (5, 2, 1)[i]
    out = mixed(frame, plan_mix(frame, shards=4, blocks_per_shard=8), "in_shard").collect()
    whole = {}
    for _, text, source in rows:
        whole[source, text] = whole.get((source, text), 0) + 1
    got, cut, shards = {}, [], set()
    for r in out:
        got[r["source"]] = got.get(r["source"], 0) + len(r["text"].split())
        cut += [r["source"]] * ((r["source"], r["text"]) not in whole)
        shards.add(r["in_shard"])
    expected = plain_targets(sizes, weights, 1.5, 2.0)
    assert got == {s: int(t + 0.5) for s, t in expected.items() if t}
    assert len(cut) == len(set(cut)) and shards == set(range(4))


def test_equal_but_for_nulls_are_different_rows(spark):
    kind = "doc_id long, text string, source string, a string, b string, c array<string>"
    rows = [(1, "x y", "s", "n", None, None), (1, "x y", "s", None, "n", None), (1, "x y", "s", None, None, ["n", None]), (1, "x y", "s", None, None, [None, "n"])]
    frame = spark.createDataFrame(rows, kind)
    found = mixed(frame, plan_mix(frame, share=1.0, ceiling=1.0)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, rows))
