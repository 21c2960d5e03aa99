"""The registered queries: those with SQL against it, and nothing else in the library needs them."""

import subprocess
import sys
from pathlib import Path

import pytest

from oreflow.llm.queries import ORACLE, QUERIES
from oreflow_checks import compare

SMALL = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name, monkeypatch):
    monkeypatch.setitem(compare.QUERIES, name, QUERIES[name])
    monkeypatch.setitem(compare.ORACLE, name, ORACLE[name])
    assert compare.difference(spark, compare.oracle_connection(SMALL), name, SMALL) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_the_rest_does_not_import_the_subpackage():
    for path in [*REPO.glob("oreflow/**/*.py"), *REPO.glob("oreflow_checks/*.py")]:
        if "llm" not in path.relative_to(REPO).parts:
            assert "oreflow.llm" not in path.read_text(), path


def test_entry_imports_without_the_subpackage():
    hide = "import sys; sys.modules['corpus_pipeline'] = None; import importlib.abc\n" \
        "class No(importlib.abc.MetaPathFinder):\n" \
        "    def find_spec(self, name, path, target=None):\n" \
        "        if name in ('oreflow.llm', 'corpus_pipeline'): raise ModuleNotFoundError(name=name)\n" \
        "sys.modules.pop('corpus_pipeline'); sys.meta_path.insert(0, No())\n" \
        "import __spark_entry__ as e; assert 'scd1_apply_changes' in e.queries() and 'op1_bpe' not in e.queries() and 'pipeline' not in e.oracle_sql()"
    subprocess.run([sys.executable, "-c", hide], cwd=REPO, check=True)
