"""The registered corpus queries against their SQL twins, and the pipeline's stages."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from oracle import DATA, both, connect  # noqa: E402

import corpus_pipeline  # noqa: E402
from tidemark.llm.queries import ORACLES, QUERIES  # noqa: E402
from tidemark.sources.tables import table  # noqa: E402


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLES)))
def test_query(spark, name):
    got, want = both(spark, connect(), QUERIES[name], ORACLES[name])
    assert got == want


def test_pipeline(spark):
    docs = table(spark, DATA, "documents")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA).cache()
        n = out.count()
        if name != "packing":
            assert out.columns == columns and 0 < n <= rows
            docs, rows = out, n
    assert out.select("doc_id").distinct().count() == rows
