"""Every operator on nulls, empty and very long texts, repeated rows,
clashing extra columns and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from turnmill.llm import (decontaminate, gru_lm, language_id, line_windows, maxscore, mixing, probminhash, quality,
                          secret_scan, sharding)

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, row string, key string, id bigint, "
          "shard int, score double, low int, n bigint, `class` string, word string")
LONG = " ".join(f"w{i % 977}x{i}" for i in range(40_000))


def rows():
    def r(i, t, lang="en", source="s"):
        return (i, t, lang, source, 1, "r", "k", 5, 9, 0.5, 1, 2, "c", "w")

    return [
        r(1, "one two three four five six seven eight\nline b\nline c\nline d"),
        r(2, "one two three four five six seven eight\nline b\nline c\nline d"),
        r(2, "one two three four five six seven eight\nline b\nline c\nline d"),
        r(3, None), r(4, ""), r(5, "   \n\n\n "), r(None, "text of no id", None, None), r(None, None, None, None),
        r(6, "!!! ??? 123"), r(7, LONG), r(8, "é" * 100_000, "fr", None), r(9, "x"),
        r(10, 'key = "abcd1234EFGH"\npassword = key', None),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, 1, 0), (6, 0, 0), (3, None, 0), (None, 0, 1), (7, 1, 0)],
                                 "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "one two three four five six seven eight line b line c")],
                                 "item_id bigint, text string")


def ids(df, col="doc_id"):
    return sorted((r[col] for r in df.select(col).collect()), key=lambda x: (x is None, x))


ALL = sorted((r[0] for r in rows()), key=lambda x: (x is None, x))


def test_language(docs, none):
    got = language_id.identify(docs, docs)
    assert got.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score"]
    by = {(r["doc_id"], r["text"]): r for r in got.collect()}
    assert ids(got) == ALL
    for text in (None, "", "   \n\n\n ", "!!! ??? 123"):
        assert [r["lang_pred"] for k, r in by.items() if k[1] == text] == ["und"] * len({k for k in by if k[1] == text})
    assert by[8, "é" * 100_000]["lang_pred"] == "fr" and 0.5 <= by[8, "é" * 100_000]["score"] <= 1
    assert {r["lang_pred"] for r in language_id.identify(docs, none).collect()} == {"und"}
    assert language_id.identify(none, docs).count() == 0


def test_mixing(docs, none):
    got = mixing.mix(docs)
    assert got.count() == len(ALL)
    assert got.where("_p is null or _p <= 0 or _p > 1").count() == 0
    assert mixing.mixed(docs).columns == docs.columns
    same = {(r["row"]["doc_id"], r["row"]["text"]): r["_kept"] for r in got.collect()}
    assert all(same[r["row"]["doc_id"], r["row"]["text"]] == r["_kept"] for r in got.collect())
    assert mixing.mixed(none).count() == 0


def test_language_model(docs, none):
    got = gru_lm.score_texts(docs, docs).collect()
    assert sorted((r["id"] for r in got), key=lambda x: (x is None, x)) == ALL
    empty = [r for r in got if r["n_tokens"] == 1 and r["id"] in (3, 4, 5)]
    assert len(empty) == 3 and len({r["score"] for r in empty}) == 1
    twice = [(r["n_known"], r["base_score"], r["score"]) for r in got if r["id"] == 2]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert all(r["score"] <= 0 and r["base_score"] <= 0 for r in got)
    unknown = gru_lm.score_texts(docs, none).collect()
    assert {r["n_known"] for r in unknown} == {0} and len(unknown) == len(ALL)
    assert gru_lm.score_texts(none, docs).count() == 0


def test_search(spark):
    d = spark.createDataFrame([(20, [1.0, None]), (20, [0.5, 0.5]), (20, [0.5, 0.25]), (0, [float("nan"), 1.0]), (40, None), (1, [0.5]),
                               (2, [float("inf")]), (None, [1.0]), (3, []), (5, [0.5, 1.0]), (6, [0.5, 1.0])], "vec_id bigint, embedding array<double>")
    got = [tuple(r) for r in maxscore.neighbours(d).orderBy("query_id", "rank").collect()]
    assert got == [(20, 1, 5, 2048), (20, 2, 6, 2048), (20, 3, 1, 1024), (20, 4, 3, 0)]
    assert maxscore.neighbours(d.limit(0)).count() == 0


def test_secrets(docs, none):
    got = {r["doc_id"]: r for r in secret_scan.secret_table(docs.where("doc_id is not null")).collect()}
    assert got[10]["spans"] == "literal:7:19" and got[10]["n_assign"] == 0
    assert got[3]["spans"] == got[4]["spans"] == "" and got[3]["base_sha256"].startswith("e3b0c442")
    assert ids(secret_scan.secret_table(docs)) == ALL
    assert secret_scan.secret_table(none).count() == 0


def test_sharding(docs, none):
    got = sharding.shard_documents(docs, shards=4)
    assert got.columns == [c for c in docs.columns if c != "shard"] + ["shard", "slot"]
    assert ids(got) == ALL
    sizes = sorted(r["count"] for r in got.groupBy("shard").count().collect())
    assert sizes == [3, 3, 3, 4]
    assert got.groupBy("shard").agg((F.max("slot") + 1 - F.countDistinct("slot")).alias("gap")).where("gap != 0").count() == 0
    assert sharding.shard_documents(none).count() == 0 and sharding.shard_table(none).count() == 0
    assert ids(sharding.shard_table(docs)) == ALL


def test_quality(docs, none, labels):
    got = quality.judged(docs, labels)
    assert got.count() == len(ALL) and got.where("keep is null or low is null or toxic is null").count() == 0
    assert quality.accepted(docs, labels).columns == docs.columns
    assert quality.accepted(docs, labels.limit(0)).count() == len(ALL)
    assert quality.accepted(none, labels).count() == 0


def test_lines(docs, none):
    got = line_windows.dedup_lines(docs)
    assert ids(got) == ALL
    by = {r["doc_id"]: r for r in got.collect()}
    assert by[1]["n_removed"] == 0 and by[2]["spans"] == "0-4" and by[2]["clean_text"] == ""
    assert by[3]["clean_text"] is None and by[3]["n_lines"] == 0 and by[4]["n_lines"] == 1
    assert by[7]["clean_text"] == LONG
    assert line_windows.dedup_lines(none).count() == 0


def test_decontamination(docs, none, items):
    got = sorted((r["doc_id"], r["item_id"], r["edits"]) for r in decontaminate.leak_table(docs, items).collect())
    assert got == [(1, 3, 0), (2, 3, 0), (2, 3, 0)]
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns and left.count() == len(ALL) - 3
    assert decontaminate.clean(docs, items.limit(0)).count() == len(ALL)
    assert decontaminate.clean(none, items).count() == 0


def test_near_duplicates(docs, none):
    got = probminhash.classes(docs)
    assert ids(got) == ALL
    by = {r["doc_id"]: r["class_id"] for r in got.collect() if r["doc_id"] is not None}
    assert by == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9, 10: 10}
    left = probminhash.deduplicated(docs)
    assert left.columns == docs.columns
    assert ids(left) == [1, 3, 4, 5, 6, 7, 8, 9, 10, None, None]
    assert probminhash.classes(none).count() == 0 and probminhash.deduplicated(none).count() == 0


def test_stages_keep_the_columns():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near-duplicates", "decontamination", "mixing", "shards"]
