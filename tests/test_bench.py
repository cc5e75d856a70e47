"""bench.py prints one JSON line covering every registered query."""
import json
import os
import subprocess
import sys

import pytest

import __spark_entry__ as ent

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_bench_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="4", CABFLOW_DRIVER_MEM="4g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=900)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout[-2000:]
    res = json.loads(lines[0])
    assert res["unit"] == "sec" and res["sf"] == "0.001" and "failed" not in res
    assert set(res["queries"]) == set(ent.queries())
