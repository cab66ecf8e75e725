"""bench.py keeps its contract: one JSON line with metric, value, unit, queries, sf."""

import json
import os
import subprocess
import sys

from tests.conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_REPEATS="1")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py"), "ingest_valid", "reject_reasons"],
                         cwd=REPO, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and set(rec["queries"]) == {"ingest_valid", "reject_reasons"}
    assert rec["value"] > 0 and rec["metric"]


def test_entry_module_loads_by_path_from_elsewhere(tmp_path):
    """The driver may load __spark_entry__.py by file path with another working directory."""
    code = (
        "import importlib.util\n"
        f"spec = importlib.util.spec_from_file_location('e', {os.path.join(REPO, '__spark_entry__.py')!r})\n"
        "m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)\n"
        "print(len(m.queries()), len(m.oracle_sql()))\n"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), capture_output=True, text=True,
                         timeout=300, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.returncode == 0, out.stderr[-2000:]
    n_queries, n_oracles = map(int, out.stdout.split())
    assert n_queries >= n_oracles >= 45
