"""The driver contract holds without the optional subpackage and what only that needs."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


def without(*modules):
    code = (
        f"import sys; sys.modules.update(dict.fromkeys({modules!r}))\n"
        "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    )
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)


@pytest.mark.parametrize("module", ["tallymark.llm", "corpus_pipeline", "public_tokenizers"])
def test_core_queries_need_no_optional_module(module):
    from tallymark.plans.registry import QUERIES

    ran = without(module)
    assert ran.returncode == 0, ran.stderr
    n, sql = map(int, ran.stdout.split())
    assert n >= len(QUERIES) and sql >= len(QUERIES)


def test_a_missing_module_of_the_core_is_not_hidden():
    assert without("tallymark.plans.oracle").returncode != 0


def test_module_names_of_tests_are_unique():
    names = Counter(p.name for p in (ROOT / "tests").rglob("test_*.py"))
    assert [n for n, times in names.items() if times > 1] == []
