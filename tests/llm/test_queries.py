"""Registered queries beside their SQL, and the pipeline beside a plain rerun of its stages."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from skygrid.llm import queries
from tests.compare import connect, differences, frame

SF = "/root/testdata/sf0.001"


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries()) and set(queries.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_like_sql(llm, name):
    assert differences(queries.QUERIES[name](llm, SF).toPandas(), frame(connect(SF), queries.SQL[name])) is None


def test_pipeline(llm, none):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(llm, docs, SF).cache()
        if name != "bpe":
            assert out.columns == docs.columns
            assert out.join(docs, docs.columns, "left_anti").count() == 0
        else:
            read = docs.selectExpr("doc_id", "sha2(coalesce(text, ''), 256) as decoded_sha256")
            assert sorted(out.select(read.columns).collect()) == sorted(read.collect())
        sizes.append(out.count())
        docs = out
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > 0 and sizes[4] == sizes[5]
    assert corpus_pipeline.run(llm, SF).count() == sizes[5]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(llm, none, SF).count() == 0
