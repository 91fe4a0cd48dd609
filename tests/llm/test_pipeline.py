"""The corpus pipeline: every stage on its own input, and all together."""

import corpus_pipeline
import pytest
from dwelltide.llm import secret_scan
from dwelltide.llm.simhash import simhash
from dwelltide.session import settings

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "secret_scan", "source_mixing", "best_fit_packing",
    ]


def test_language_is_found_once_per_text(spark, sf_dir, capsys):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    corpus_pipeline.language_id(spark, docs, sf_dir).explain()
    plan = capsys.readouterr().out
    assert plan.count("predicted(") == plan.count("ArrowEvalPython") == 1, plan


def test_secrets_need_one_python_worker_per_task(spark, sf_dir, capsys):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    corpus_pipeline.redact_secrets(spark, docs, sf_dir).explain()
    plan = capsys.readouterr().out
    assert plan.count("replaced(") == plan.count("ArrowEvalPython") == 1, plan


def test_whole_run(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = {r["doc_id"]: r for r in docs.collect()}
    kept = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(number))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "best_fit_packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            kept[name] = docs.collect()
    assert len(kept["language_id"]) >= 0.99 * len(given)
    prints = [simhash(r["text"]) for r in kept["simhash_near_dedup"]]
    assert all((a ^ b).bit_count() > 2 for i, a in enumerate(prints) for b in prints[:i])
    # What went has a kept text near it, by a chain through the input.
    before = {r["doc_id"]: simhash(r["text"]) for r in kept["language_id"]}
    reached = set(prints)
    while more := {p for p in before.values() if p not in reached and any((p ^ q).bit_count() <= 2 for q in reached)}:
        reached |= more
    assert reached == set(before.values())
    ids = {r["doc_id"] for r in kept["simhash_near_dedup"]}
    assert {r["doc_id"] for r in kept["secret_scan"]} == ids and len(kept["secret_scan"]) == len(ids)
    for r in kept["secret_scan"]:
        clean = not secret_scan.base_spans(given[r["doc_id"]]["text"])
        assert (r["text"] == given[r["doc_id"]]["text"]) == clean
        assert r["n_chars"] == len(r["text"]) and not [s for s in secret_scan.base_spans(r["text"]) if s[1]]
    words = sum(len(r["text"].split()) for r in kept["secret_scan"])
    mixed = sum(len(r["text"].split()) for r in kept["source_mixing"])
    assert abs(mixed - 1.5 * words) <= 20
    assert docs.groupBy().sum("words").first()[0] == mixed
    run = corpus_pipeline.run(spark, sf_dir)
    key = lambda rows: sorted((r["doc_id"], r["piece"], r["text"]) for r in rows)
    assert key(run.collect()) == key(docs.collect())


@pytest.mark.parametrize("number", range(5))
def test_odd_documents(spark, sf_dir, number):
    rows = [
        (1, None, "en", "a", 0), (2, "", None, None, None), (3, "some words of a text", "en", None, 20),
        (3, "some words of a text", "en", None, 20), (4, "token = abcdefgh12 and words", "en", "b", None), (None, "more words " * 9000, "de", "b", 1),
    ]
    stage = corpus_pipeline.STAGES[number][1]
    found = stage(spark, spark.createDataFrame(rows, DOCUMENT), sf_dir).collect()
    if number == 0:
        assert sorted(str(r["doc_id"]) for r in found) == ["3", "3", "4", "None"]
    if number == 1:
        assert sorted(str(r["doc_id"]) for r in found) == ["1", "3", "4", "None"]
    if number == 2:
        assert [r["text"] for r in found if r["doc_id"] == 4] == ["[assign] and words"] and len(found) == 6
    if number == 3:
        assert found and all(r["text"] for r in found)
    if number == 4:
        assert len([r for r in found if r["doc_id"] == 3]) == 2 and len([r for r in found if r["doc_id"] is None]) == 5
    empty = stage(spark, spark.createDataFrame([], DOCUMENT), sf_dir)
    assert empty.collect() == []


#: Columns called like those of operators, and of types that have no order.
ODD = (
    ", score double, lang_pred string, lang_accepted string, _spans string, spans string, `a.b` string, `t``ick` int,"
    " row string, doc string, source_size long, found int, copies long, props map<string,int>, list array<struct<x:int>>"
)


@pytest.mark.parametrize("number", range(4))
def test_columns_of_any_name_and_type_stay(spark, sf_dir, number):
    more = lambda i: (
        i + 0.5, f"p{i}", "yes", f"_s{i}", f"s{i}", f"ab{i}", i, "r", "d", i, i, i, {"k": i, "l": None}, [(i,), (None,)],
    )
    text = "the quick brown fox and the words of a text that goes on"
    rows = [(i, f"{text} {chr(97 + i) * 5} {i * i} {i * 31 % 7}" * 3, "en", "s", 9, *more(i)) for i in range(12)]
    rows += [rows[3], rows[3], (4, rows[4][1], "en", "s", 9, *more(40)), (None, rows[5][1], "en", "s", 9, *more(41))]
    rows.append((50, None, None, None, None, *[None] * 14))
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions")}
    docs = spark.createDataFrame(rows, DOCUMENT + ODD)
    found = corpus_pipeline.STAGES[number][1](spark, docs, sf_dir)
    assert found.columns == docs.columns
    given = {}
    for r in docs.collect():
        given.setdefault(r["doc_id"], []).append(list(r)[5:])
    kept = found.collect()
    assert kept and all(list(r)[5:] in given[r["doc_id"]] for r in kept)
    assert before == {k: spark.conf.get(k, None) for k in before}
    assert found.limit(0).collect() == [] and docs.dtypes == found.dtypes
    if number == 1:
        # Texts that differ by a few words may be near; each class keeps one row.
        assert len(kept) == len({r["doc_id"] for r in kept}) == len({simhash(r["text"]) for r in kept})


def test_packing_does_not_depend_on_batches(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = []
    for size in ("10000", "100", "7"):
        with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": size}):
            found.append(sorted(map(tuple, corpus_pipeline.best_fit_packing(spark, docs, sf_dir).collect())))
    assert found[0] == found[1] == found[2]


def test_each_class_of_null_and_repeated_ids_keeps_one(spark, sf_dir):
    texts = [" ".join(f"{t}{i * i % 97}" for i in range(60)) for t in "abcdef"]
    a, b, c, d, e, f = texts
    rows = [(None, a), (None, a), (None, b), (None, b), (None, c), (5, d), (5, d), (5, e), (5, e)]
    rows += [(3, f), (5, f), (None, f), (5, f)]  # the class keeps id 3, though other classes keep 5 and null
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCUMENT)
    found = corpus_pipeline.simhash_near_dedup(spark, docs, sf_dir).collect()
    expected = [(None, a), (None, b), (None, c), (5, d), (5, e), (3, f)]
    assert sorted(map(repr, expected)) == sorted(repr((r["doc_id"], r["text"])) for r in found)
