"""The registered corpus queries against their SQL twins, on the smallest tables; and what the pipeline's stages do."""

import corpus_pipeline
import pytest
from compare import database, differences
from test_near import plain_kept

from millrace.llm.queries import ORACLES, QUERIES, load

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, db, name):
    assert differences(QUERIES[name](spark, SF), db, ORACLES[name]) == ""


def test_every_operator_is_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = load(spark, SF, "documents")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash", "decontamination", "mixing", "sharding"]
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}

    calm = stages["toxicity"](spark, docs, SF)
    scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op4_toxicity"](spark, SF).collect()}
    assert calm.columns == columns and ids(calm) == {k for k, v in scores.items() if v == 0}

    distinct = stages["simhash"](spark, docs, SF)
    assert distinct.columns == columns
    assert sorted(r["doc_id"] for r in distinct.collect()) == plain_kept(map(tuple, docs.select("doc_id", "text").collect()))

    unseen = stages["decontamination"](spark, docs, SF)
    hit = {r["doc_id"] for r in QUERIES["op1_decontamination"](spark, SF).filter("contaminated").collect()}
    assert hit and unseen.columns == columns and ids(unseen) == ids(docs) - hit

    mixed = stages["mixing"](spark, docs, SF)
    plan = {r["doc_id"]: r for r in QUERIES["op3_mixing"](spark, SF).collect()}
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert mixed.columns == columns
    for key, row in plan.items():
        passes = [min(row["size"], row["taken"]), max(0, row["taken"] - row["size"])]
        assert counts.get(key, 0) == sum(row["size"] > 0 and 2 * p >= row["size"] for p in passes)

    placed = stages["sharding"](spark, docs, SF)
    assert placed.columns == [*columns, "shard", "slot"]
    assert sorted(map(tuple, placed.select(*columns).collect())) == sorted(map(tuple, docs.collect()))


def test_run_applies_all_stages(spark):
    docs = load(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    again = corpus_pipeline.run(spark, SF)
    assert again.columns == docs.columns
    assert sorted(map(tuple, again.select("doc_id", "shard", "slot").collect())) == sorted(
        map(tuple, docs.select("doc_id", "shard", "slot").collect()))
