"""The pipeline's stages against what each operator says of its own input, and the entry without the subpackage."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from compare import duck, duck_rows, spark_rows

from weftline.llm import catalogue, decontam, langid, minhash, quality
from weftline.settings import written

SF = "/root/testdata/sf0.001"


def test_each_stage_keeps_what_its_operator_accepts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    judges = [
        lambda d: langid.predicted(d, langid.model_of(d)).where("score >= 0.5"),
        lambda d: quality.quality(d).where("kept"),
        lambda d: minhash.classes(d).where("kept"),
        lambda d: decontam.contamination(d, bench).where("not contaminated"),
    ]
    for (name, stage), judge in zip(corpus_pipeline.STAGES[:-1], judges, strict=True):
        kept = written(stage(spark, docs, SF), "stage")
        assert kept.columns == docs.columns, name
        rows = {tuple(r) for r in kept.collect()}
        assert rows <= {tuple(r) for r in docs.collect()}
        assert {r[0] for r in rows} == {r.doc_id for r in judge(docs).collect()}, name
        docs = kept
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == {r.doc_id for r in docs.collect()} and all(r.exact for r in out)


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_queries_equal_their_sql(spark):
    for name, sql in catalogue.oracle_sql().items():
        columns, got = spark_rows(catalogue.queries()[name](spark, SF))
        sql_columns, expected = duck_rows(duck(SF), sql)
        assert columns == sql_columns and got == expected and got, name


def test_entry_imports_without_the_subpackage(tmp_path):
    """The entry module and the rest of the package, copied without what is deleted."""
    import shutil

    top = Path(__file__).resolve().parents[2]
    shutil.copytree(top / "weftline", tmp_path / "weftline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(top / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') and k[2].isdigit() for k in e.queries()))"], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    assert said.stdout.split()[1] == "False"
