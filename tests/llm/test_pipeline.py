import os
import shutil
import subprocess
import sys

import pytest

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_stages(spark):
    """Each stage keeps the columns of documents, and does on its input what its operator is tested for."""
    from docsift.llm import decontaminate, jaccard, langid
    from docsift.session import materialize
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for name, stage in P.STAGES[:-1]:
        seen.append(materialize(stage(spark, seen[-1], SF), "stage"))
        assert seen[-1].columns == docs.columns, name
    ids = [{r[0] for r in d.select("doc_id").collect()} for d in seen]
    rejected = {r["doc_id"] for r in langid.identify(seen[0]).filter("rejected").collect()}
    assert ids[1] == ids[0] - rejected and ids[2] == ids[1]
    groups = {r["component_id"] for r in jaccard.join(seen[2]).collect()}
    assert ids[3] == groups
    leaks = {r["doc_id"] for r in decontaminate.leaks(seen[3], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert ids[4] == ids[3] - leaks and leaks
    pieces = P.run(spark, SF)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == ids[4]


def test_the_rest_works_without_this_part(tmp_path):
    for name in ("docsift", "workload", "__spark_entry__.py"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; assert 'find_by_id' in e.queries() and 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
