"""The registered queries: SQL where there is some, and the pipeline against its stages."""

import pytest

import corpus_pipeline
from dcflow.llm import decontam, linededup, quality, simhash
from dcflow.llm.queries import ORACLE_SQL, QUERIES
from dcflow.plans.oracle import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    res = compare(QUERIES[name](spark, SF), ORACLE_SQL[name], SF)
    assert res["match"], res


def test_pipeline_keeps_what_its_stages_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("benchmark", "labels"))
    left = quality.keep_good(docs, quality.learn_rules(docs, labels))
    left = decontam.drop_contaminated(simhash.keep_one(linededup.drop_later_copies(left)), bench)
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(r["doc_id"] for r in left.select("doc_id").collect())
    assert len(corpus_pipeline.STAGES) == 5
    from dcflow.session import list_names, scratch_path
    left_over = [n for n in list_names(spark, scratch_path(spark, "x").rsplit("/", 1)[0]) if n.startswith("pipeline-")]
    assert len(left_over) == 1 and left_over[0].startswith("pipeline-benchmark_decontamination")  # what the result is read from
