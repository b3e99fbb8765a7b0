"""What operators stage is removed with the scope that it is staged in."""

from __future__ import annotations

from pathlib import Path

import pytest

import corpus_pipeline
from tidemark.llm.common import scratch, stage
from tidemark.llm.queries import QUERIES
from tidemark.session import shared_root

STAGING = ["op3_suffix_dedup", "op4_host_rules", "op9_simhash", "op11_packing", "op12_alignment", "op13_repair"]


def left(spark):
    """Folders below the shared one, but for reliable checkpoints, and tables in the catalog."""
    root = Path(shared_root(spark).removeprefix("file:"))
    return {x.name for x in root.iterdir()}, {x.name for x in spark.catalog.listTables()}


@pytest.mark.parametrize("name", STAGING)
def test_a_written_result_leaves_nothing_else(spark, small, tmp_path, name):
    before = left(spark)
    with scratch(spark) as own:
        found = QUERIES[name](spark, small)
        found.write.parquet(f"{tmp_path}/out")
        assert own.folders
    assert left(spark) == before
    assert spark.read.parquet(f"{tmp_path}/out").count() > 0


def test_the_pipeline_leaves_its_output(spark, small):
    folders, tables = left(spark)
    found = corpus_pipeline.run(spark, small)
    after, tables_after = left(spark)
    (output,) = after - folders
    assert output.startswith("BPE-encoding") and tables_after == tables
    assert found.count() > 0


def test_scopes_are_nested_and_survive_failures(spark):
    before = left(spark)
    with scratch(spark):
        kept = stage(spark.range(3), "outer")
        with pytest.raises(ZeroDivisionError), scratch(spark):
            stage(spark.range(5), "inner")
            1 / 0
        assert kept.count() == 3
        assert len(left(spark)[0] - before[0]) == 1
    assert left(spark) == before
    stage(spark.range(2), "stays")
    assert len(left(spark)[0] - before[0]) == 1
