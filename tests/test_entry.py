"""The driver's entry: a broken core module is no silence, a missing corpus package costs only its queries."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(code):
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)


def test_a_broken_core_module_raises():
    r = _run("import sys; sys.modules['jurisdiff.operators.orphans'] = None\nimport __spark_entry__")
    assert r.returncode and "jurisdiff.operators.orphans" in r.stderr


def test_a_missing_package_of_the_corpus_operators_costs_only_their_queries():
    r = _run("import sys; sys.modules['jurisdiff.llm.queries'] = None\nimport __spark_entry__ as e; q = e.queries(); print('p1_found' in q, 'event_dedupe' in q, 'p3_found' in q, set(e.oracle_sql()) <= set(q))")
    assert r.stdout.split() == ["True", "True", "False", "True"], r.stderr
