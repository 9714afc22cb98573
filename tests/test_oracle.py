"""Every registered query against its independent DuckDB formulation
(sf0.001: the whole tables, small enough for a quick run; the driver's
own check runs the same pairs at sf0.01)."""

import pytest

import __spark_entry__ as E
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLE = {k: v for k, v in E.oracle_sql().items() if not k.startswith("op") or k == "output_accounting"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, n, _, detail = compare(spark, con, SF, name, QUERIES[name], ORACLE[name])
    assert ok, detail


# The training-data queries have tests of their own (tests/llm).
@pytest.mark.parametrize("name", sorted(q for q in set(QUERIES) - set(ORACLE) if q != "pipeline" and not q.startswith("op")))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["conv_id", "segment", "turn", "role", "text"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    rows_only = {q for q in set(QUERIES) - set(ORACLE) if q != "pipeline" and not q.startswith("op")}
    assert rows_only <= {"router_model_predictions"}


@pytest.mark.parametrize("chunk_rows", [65536, 1, 2, 3])
def test_segmentation_chunk_sizes_agree_with_oracle(spark, chunk_rows):
    """Chunk boundaries everywhere (1-3 turns per chunk) must not change
    the segments: the skew-safe path equals the oracle at sf0.01."""
    from turnmill.operators import segments as seg
    from turnmill.plans.registry import DATA_MARKER
    from turnmill.sources import tables

    sf = "/root/testdata/sf0.01"
    fn = lambda s, d: seg.split_segments(tables.conversation_turns(s, d), marker=DATA_MARKER, chunk_rows=chunk_rows)
    ok, n, _, detail = compare(spark, duck(sf), sf, "segment_turns", fn, ORACLE["segment_turns"])
    assert ok and n == 569, detail


@pytest.mark.parametrize("chunk_rows", [1, 2, 3])
@pytest.mark.parametrize("name", ["turn_collapse", "alternation_repair", "disposition_ledger", "clean_conversations",
                                  "trace_conversations"])
def test_turn_building_chunk_sizes_agree_with_oracle(spark, con, monkeypatch, chunk_rows, name):
    """Run ids and trims must not depend on where chunks are cut."""
    from turnmill.operators import turns as turns_op

    monkeypatch.setattr(turns_op, "CHUNK_ROWS", chunk_rows)
    ok, n, _, detail = compare(spark, con, SF, name, QUERIES[name], ORACLE[name])
    assert ok, detail


@pytest.mark.parametrize("chunk", [1, 3])
@pytest.mark.parametrize("name", ["chunk_merge", "usage_carry", "trace_conversations"])
def test_chunk_merge_chunk_sizes_agree_with_oracle(spark, con, monkeypatch, chunk, name):
    """Epochs and message numbers must not depend on where chunks are cut."""
    from turnmill.operators import events as ev_op

    monkeypatch.setattr(ev_op, "CHUNK_ROWS", chunk)
    ok, n, _, detail = compare(spark, con, SF, name, QUERIES[name], ORACLE[name])
    assert ok, detail
