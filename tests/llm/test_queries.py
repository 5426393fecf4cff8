"""The registered queries of this part against their SQL on the smallest tables."""

import os
import subprocess
import sys

import pytest
from oracle import compare, connect, repo

import corpus_pipeline
from stratalake.llm import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    assert compare(spark, connect(SF), SF, name) == ""


def test_all_are_registered():
    assert [n for n in range(1, 14) if any(name.startswith(f"op{n}_") for name in repo.queries())] == list(range(1, 14))
    assert repo.queries().keys() >= {*registry.QUERIES, *corpus_pipeline.QUERIES}


def test_nothing_else_imports_this_part():
    root = os.path.dirname(os.path.abspath(repo.__file__))
    out = subprocess.run(["grep", "-rl", "stratalake.llm", f"{root}/stratalake", "--include=*.py"], capture_output=True, text=True)
    assert all("/llm/" in path for path in out.stdout.split())
    code = "import sys; sys.modules['corpus_pipeline'] = None; import importlib.util as u, __spark_entry__"
    code = "import importlib.util as u; f = u.find_spec; u.find_spec = lambda n, *a: None if 'llm' in n else f(n, *a); import __spark_entry__ as e; assert 'pipeline' not in e.queries()"
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
