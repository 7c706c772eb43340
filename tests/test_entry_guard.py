"""The entry module without the optional subpackage or one of its libraries."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def entry(setup: str) -> str:
    code = f"import sys, warnings; sys.path.insert(0, {ROOT!r}); {setup}\n" + (
        "with warnings.catch_warnings(record=True) as said:\n"
        "    warnings.simplefilter('always')\n"
        "    import __spark_entry__ as e\n"
        "print(len(e.queries()), len(e.oracle_sql()), sorted(k for k in e.queries() if k.startswith('op') or k == 'pipeline'))\n"
        "print([str(w.message) for w in said if 'training-data' in str(w.message)])\n"
    )
    return subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=120).stdout


def test_a_missing_library_loses_only_the_training_data_queries():
    out = entry("sys.modules['duckdb'] = None")
    count, twins = map(int, out.split()[:2])
    assert count == twins >= 52 and "[]" in out.splitlines()[0]
    if os.path.isdir(os.path.join(ROOT, "searchlake", "llm")):
        assert "duckdb" in out.splitlines()[1]
