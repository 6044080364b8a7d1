"""The driver contract without the training-data subpackage."""

import json
import os
import shutil
import subprocess
import sys

from tests.conftest import ROOT

PROBE = """
import json
import __spark_entry__ as entry
print(json.dumps([sorted(entry.queries()), sorted(entry.oracle_sql())]))
"""


def probe(folder):
    done = subprocess.run([sys.executable, "-c", PROBE], cwd=folder, env={**os.environ, "PYTHONPATH": str(folder)},
                          capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return json.loads(done.stdout)


def copy_of(tmp_path, keep_pipeline):
    skip = shutil.ignore_patterns("llm", "__pycache__", ".git", *([] if keep_pipeline else ["corpus_pipeline.py"]))
    target = tmp_path / ("with" if keep_pipeline else "without")
    shutil.copytree(ROOT, target, ignore=skip)
    return target


def test_the_rest_imports_without_the_subpackage(tmp_path):
    for keep_pipeline in (False, True):
        queries, oracles = probe(copy_of(tmp_path, keep_pipeline))
        assert len(queries) >= 60 and queries == oracles
        assert not any(q.startswith("op") or q == "pipeline" for q in queries)


def test_other_missing_modules_are_not_swallowed(tmp_path):
    target = copy_of(tmp_path, False)
    (target / "kestrel" / "llm").mkdir()
    (target / "kestrel" / "llm" / "__init__.py").write_text("")
    (target / "kestrel" / "llm" / "queries.py").write_text("import no_such_module\n")
    done = subprocess.run([sys.executable, "-c", PROBE], cwd=target, env={**os.environ, "PYTHONPATH": str(target)},
                          capture_output=True, text=True, timeout=120)
    assert "no_such_module" in done.stderr and done.returncode
