import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture
def sf_dir(spark, tmp_path):
    """The small tables with odd rows and an extra column with a clashing name."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(9000, None, None, None, None), (9001, "", "en", "src0", 0), (9002, " \n", "fr", None, 2), (None, "one", "en", "src1", 3)]
    odd = spark.createDataFrame(odd, docs.schema)
    docs.union(odd).union(docs.limit(3)).withColumn("Kept", F.lit("own")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_each_stage_filters_its_predecessor_and_the_whole_run_packs_the_rest(spark, sf_dir):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs
    for i, (name, stage) in enumerate(P.STAGES[:-1]):
        stage(spark, before, sf_dir).write.parquet(f"{sf_dir}/stage{i}")
        after = spark.read.parquet(f"{sf_dir}/stage{i}")
        assert after.columns == columns, name
        assert 0 < after.count() <= before.count(), name
        assert after.exceptAll(before).count() == 0, name
        before = after
    from geotrace.llm.simhash import near_groups
    assert near_groups(spark.read.parquet(f"{sf_dir}/stage2")).where("NOT is_representative").count() == 0
    kept = spark.read.parquet(f"{sf_dir}/stage3").select("doc_id").collect()
    pieces = P.run(spark, sf_dir).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in kept}
    assert all(len(p.ids) == p.length for p in pieces)
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())


def test_empty_documents(spark, tmp_path):
    import corpus_pipeline as P

    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_every_numbered_operator_and_the_pipeline_are_registered():
    names = E.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names


def test_nothing_else_imports_the_subpackage():
    for p in [*ROOT.glob("geotrace/**/*.py"), ROOT / "bench.py"]:
        if "llm" not in p.relative_to(ROOT).parts:
            assert not re.search(r"geotrace\.llm|from geotrace import llm|corpus_pipeline", p.read_text()), p


def test_twins_match_on_small_data(spark):
    import duckdb

    from scripts.compare_oracle import digest
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    for k in ("op2_sharding", "op5_mixing", "op6_quality_rules"):
        df = E.queries()[k](spark, SF)
        cur = con.execute(E.oracle_sql()[k])
        rows = cur.fetchall()
        assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest([c[0] for c in cur.description], rows)[0], k
