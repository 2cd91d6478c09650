"""The driver contract with and without the training-data subpackage."""

import subprocess
import sys
import textwrap

import __spark_entry__ as E
from presslake.plans.job_queries import JOB_QUERIES
from presslake.plans.queries import QUERIES as TABLE_QUERIES

QUERIES = {**TABLE_QUERIES, **JOB_QUERIES}


def test_queries_without_the_subpackage():
    code = textwrap.dedent("""
        import sys
        sys.modules["presslake.llm"] = None      # as if the folder were not there
        sys.modules["corpus_pipeline"] = None
        import __spark_entry__ as E
        print(len(E.queries()), len(E.oracle_sql()))
    """)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                         cwd=E.__file__.rpartition("/")[0])
    assert out.returncode == 0, out.stderr
    assert out.stdout.split() == [str(len(QUERIES))] * 2


def test_nothing_else_imports_the_subpackage():
    code = ("import sys, pkgutil, importlib, presslake\n"
            "for m in pkgutil.walk_packages(presslake.__path__, 'presslake.'):\n"
            "    if not m.name.startswith('presslake.llm'): importlib.import_module(m.name)\n"
            "print([m for m in sys.modules if m.startswith('presslake.llm.')])")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                         cwd=E.__file__.rpartition("/")[0])
    assert out.stdout.strip() == "[]", out.stderr
