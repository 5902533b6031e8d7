import os
import shutil
import subprocess
import sys

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def test_entry_and_registry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 3 and set(df.columns) >= {"scenario", "overall_status", "summary"}
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {name for name in q if name not in E.LLM_QUERIES}
    assert own == set(o) - set(E.LLM_ORACLES)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_properties(spark):
    q = E.queries()
    sig_plan = _plan(q["signals"](spark, SF_SMALL))
    # the batch signal engine stays in the JVM: no Python evaluation nodes
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in sig_plan
    assert "CartesianProduct" not in sig_plan
    # one day's folder, a week's folders, and nothing else, are opened
    files = q["snapshot_day"](spark, SF_SMALL).inputFiles()
    assert files and all("snapshot_date=2024-01-15/" in f for f in files)
    days = {f.split("snapshot_date=")[1][:10] for f in q["recent_inference"](spark, SF_SMALL).inputFiles()}
    assert days == {f"2024-01-{d}" for d in range(14, 21)}
    shift = _plan(q["drift_shift"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_linenumber:int,l_quantity:double" in shift.replace("bigint", "int")
    assert "ExistingRDD" not in shift and "Window" not in shift


def test_entry_without_the_text_operators(tmp_path):
    """A copy without the llm folders (an empty one may be left) still has all other queries."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", "*.json", "*.md")
    shutil.copytree(root, tmp_path / "copy", ignore=skip)
    for left in (False, True):
        if left:
            (tmp_path / "copy/driftline/llm/__pycache__").mkdir(parents=True)
        out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                             cwd=tmp_path / "copy", capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""})
        own = len(E.queries()) - len(E.LLM_QUERIES)
        assert out.stdout.split() == [str(own), str(own)], out.stderr
