"""The entry point without the training-data subpackage, and the scratch folder
without a setting."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code, cwd, **env):
    return subprocess.run([sys.executable, "-c", code], cwd=cwd, text=True,
                          capture_output=True, timeout=300, env={
                              **os.environ, "PYTHONPATH": str(cwd), **env})


def test_entry_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(
        ".git", "llm", "__pycache__", ".pytest_cache"))
    got = run("import __spark_entry__ as e; q = e.queries(); "
              "print(len(q), 'pipeline' in q, any(n[:2] == 'op' and "
              "n[2:3].isdigit() for n in q), set(e.oracle_sql()) <= set(q))", copy)
    assert got.returncode == 0, got.stderr
    n, *rest = got.stdout.split()
    assert int(n) >= 79 and rest == ["False", "False", "True"]


def test_scratch_folder_without_a_setting(tmp_path):
    empty = tmp_path / "conf"
    empty.mkdir()
    got = run("""
from pricelake.session import local_session, checkpoint_dir
s = local_session(1)
assert not s.sparkContext.getConf().get("spark.checkpoint.dir", None)
a = checkpoint_dir(s)
assert a == checkpoint_dir(s)
s.range(3).write.parquet(a + "/t")
print(s.read.parquet(a + "/t").count())
""", ROOT, SPARK_CONF_DIR=str(empty))
    assert got.stdout.strip().endswith("3"), got.stderr[-2000:]
