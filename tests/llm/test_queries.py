import duckdb  # noqa: F401
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from strata.llm.common import read
from strata.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs_over_the_given_tables(spark, name):
    rows = contract.queries()[name](spark, SF)
    expected = {"op5_ann": 10, "op7_decontaminate": 0, "op8_chat": 2}
    least = expected.get(name, read(spark, SF, "documents").count())
    assert rows.count() >= least


def test_pipeline_keeps_columns_and_round_trips(spark):
    docs = read(spark, SF, "documents")
    columns, frame = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SF)
        assert frame.columns == columns, name
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and out.filter("NOT round_trip").isEmpty()
    assert out.select("doc_id").distinct().count() == out.count()
