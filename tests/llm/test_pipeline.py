"""The pipeline stage by stage on sf0.001: what each stage keeps, held
against plain versions, and the whole run."""

import math

import corpus_pipeline as C
from turnmill.llm import decontaminate, mixing
from turnmill.llm.common import read

SF = "/root/testdata/sf0.001"


def five(t):
    w = t.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages_on_real_documents(spark, tmp_path):
    docs = read(spark, SF, "documents")
    columns = docs.columns
    before = {r["doc_id"]: r for r in docs.collect()}
    items = [decontaminate.normal(r["text"]) for r in read(spark, SF, "benchmark").collect()]
    for k, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        after = {r["doc_id"]: r for r in docs.collect()}
        assert docs.columns == columns + (["shard", "slot"] if name == "shards" else [])
        assert set(after) <= set(before) and docs.count() == len(after)
        assert all(tuple(after[i])[: len(columns)] == tuple(before[i])[: len(columns)] for i in after)
        if name == "near-duplicates":
            s = {i: five(r["text"]) for i, r in before.items()}
            kept = sorted(after)
            for x, i in enumerate(kept):
                assert not [j for j in kept[x + 1 :] if s[i] and len(s[i] & s[j]) >= 0.8 * len(s[i] | s[j])]
            for i in set(before) - set(after):  # every dropped document is near a document of its stage's input
                assert [j for j in before if j != i and (before[i]["text"] == before[j]["text"] or len(s[i] & s[j]) >= 0.8 * len(s[i] | s[j]))]
        if name == "decontamination":
            for i, r in before.items():
                text = decontaminate.normal(r["text"])
                whole = any(x in text for x in items if len(x) >= decontaminate.MIN_ITEM)
                assert not (whole and i in after)
        if name == "mixing":
            p = {r["row"]["doc_id"]: r["_p"] for r in mixing.mix(spark.read.parquet(str(tmp_path / str(k - 1)))).collect()}
            mean, sd = sum(p.values()), math.sqrt(sum(x * (1 - x) for x in p.values()))
            assert abs(len(after) - mean) < 5 * sd + 1
        if name == "shards":
            assert set(after) == set(before)
            by = {}
            for r in after.values():
                by.setdefault(r["shard"], []).append(r["slot"])
            assert all(sorted(v) == list(range(len(v))) for v in by.values())
            sizes = [len(by.get(x, [])) for x in range(40)]
            assert max(sizes) - min(sizes) <= 1
        before = after


def test_run_is_repeatable(spark):
    a, b = C.run(spark, SF), C.run(spark, SF)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
