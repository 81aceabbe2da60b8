"""Every registered query against its SQL, and the pipeline against a brute-force version."""

import pytest

import corpus_pipeline
from litpulse.llm import rules
from litpulse.llm.queries import ORACLES, QUERIES
from tests.compare import compare, connect


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, name):
    error, n = compare(QUERIES[name](spark, sf), connect(sf), ORACLES.get(name))
    assert not error and n


def test_pipeline(spark, sf):
    """Stage by stage on its own input: who stays follows from the operators' brute-force tests."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        frames.append(docs)
    ids = [[r.doc_id for r in f.select("doc_id").collect()] for f in frames]
    good = {r.doc_id for r in rules.ledger(frames[0]).where(rules.passes()).collect()}
    assert set(ids[1]) == good and len(ids[1]) == len(good)
    lines = [x for r in frames[2].collect() for x in r.text.split("\n") if len(x.strip()) >= 12]
    assert len({x.strip() for x in lines}) == len(lines)
    assert set(ids[3]) <= set(ids[2]) and len(set(ids[3])) == len(ids[3])
    assert set(ids[4]) <= set(ids[3]) and max(map(ids[4].count, set(ids[4]))) <= 2
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r.doc_id for r in got if r.piece == 0) == sorted(ids[4])
    used = {}
    for r in got:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 1024
