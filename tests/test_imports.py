"""The entry module can be read before a session exists, with and without its optional part."""

import os
import subprocess
import sys

import pytest

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("before", ["", "sys.modules['rtml.llm'] = None;"])
def test_entry_without_a_session(before):
    code = f"import sys; {before} import __spark_entry__ as e; " \
           "assert e.queries() and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=TOP, check=True)
