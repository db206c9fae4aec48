import os

import pytest

from helpers import groups, jaccard_links, shingles

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    import __spark_entry__ as entry
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_pipeline_stage_by_stage(spark, tmp_path):
    import corpus_pipeline as pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before, steps = docs.columns, docs, {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, before, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        steps[name] = (before, after)
        before = after
    for name, _ in pipeline.STAGES[:-1]:
        assert steps[name][1].columns == columns
    old, new = steps["jaccard_join"]
    sets = {r["doc_id"]: shingles(r["text"]) for r in old.collect()}
    component = groups(sets, jaccard_links)
    assert {r["doc_id"] for r in new.collect()} == {i for i, c in component.items() if i == c}
    old, new = steps["secret_scan"]
    assert old.count() == new.count() and new.where("text rlike 'AKIA[A-Z0-9]{16}'").isEmpty()
    old, new = steps["mixing"]
    assert new.groupBy("doc_id").count().where("count > 2").isEmpty()
    old, new = steps["bpe"]
    assert old.count() == new.count() and new.where("size(ids) <> n_tokens").isEmpty()


def test_pipeline_of_empty_tables_and_clashing_names(spark, tmp_path):
    import corpus_pipeline as pipeline
    from helpers import ODD_TEXTS, docs_frame
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    prose = "A plain line of words that reads like any other text here."
    for name, rows in (("empty", []), ("odd", [(i, t, s) for i, t, s in ODD_TEXTS] + [(50, prose, "a"), (51, prose, "a")])):
        docs_frame(spark, rows, extra=True).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    assert pipeline.run(spark, f"{tmp_path}/empty").count() == 0
    docs = first = spark.read.parquet(f"{tmp_path}/odd/documents.parquet")
    for _, stage in pipeline.STAGES[1:-1]:      # without labels the first stage keeps nothing
        docs = stage(spark, docs, f"{tmp_path}/odd")
        assert docs.columns == first.columns
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert 50 in ids and 51 not in ids


def test_matches_too_long_are_refused(spark):
    from helpers import docs_frame
    from martflow.llm.suffix_dedup import dedup
    with pytest.raises(ValueError, match="at most 128"):
        dedup(docs_frame(spark, []), match=200)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", ["op1_mixing", "op5_jaccard_join", "op7_block_search"])
def test_sql_gives_the_same(spark, name):
    import duckdb

    from martflow.llm.queries import ORACLE_SQL, QUERIES
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want, got = con.execute(ORACLE_SQL[name]).df(), QUERIES[name](spark, SF).toPandas()
    cols = sorted(got.columns)
    a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    assert len(a) == len(b) and (a == b).all().all()
