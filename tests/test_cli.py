"""The spark-submit entry points, run as separate processes (own JVM)."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT, SF_SMALL

ENV = {**os.environ,
       "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false "
                              "--conf spark.ui.showConsoleProgress=false pyspark-shell"}


def run(*args: str) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, *args], cwd=ROOT, env=ENV, capture_output=True, text=True, timeout=600)


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("cli") / "b")
    done = run("jobs/batch.py", "--tables", SF_SMALL, "--out", folder, "--preview", "0")
    assert done.returncode == 0, done.stderr[-2000:]
    return folder


def test_batch_then_export_cli(base, tmp_path):
    assert len(os.listdir(f"{base}/kpis")) == 8 and len(os.listdir(f"{base}/kpis_sql")) == 8
    out = str(tmp_path / "export")
    done = run("jobs/export.py", "--kpis", f"{base}/kpis", "--out", out)
    assert done.returncode == 0, done.stderr[-2000:]
    assert len([f for f in os.listdir(out) if f.endswith(".csv")]) == 1


def test_export_cli_fails_when_no_kpi_is_readable(tmp_path):
    done = run("jobs/export.py", "--kpis", str(tmp_path / "nothing"), "--out", str(tmp_path / "out"))
    assert done.returncode == 1
    assert "none of the KPI tables could be read" in done.stderr


def test_stream_cli_restart_resumes_from_stable_checkpoint(tmp_path):
    import pyarrow.parquet as pq

    msgs, out = str(tmp_path / "msgs"), str(tmp_path / "alerts")
    assert run("jobs/publish.py", "--tables", SF_SMALL, "--out", msgs).returncode == 0

    def alerts() -> int:
        return sum(pq.read_metadata(os.path.join(out, f)).num_rows for f in os.listdir(out) if f.endswith(".parquet"))

    first = run("jobs/stream.py", "--input", msgs, "--out", out, "--available-now")
    assert first.returncode == 0, first.stderr[-2000:]
    assert alerts() == 40
    second = run("jobs/stream.py", "--input", msgs, "--out", out, "--available-now")
    assert second.returncode == 0, second.stderr[-2000:]
    assert alerts() == 40
    # Events that come between two runs: the same messages under other names.
    for name in [f for f in os.listdir(msgs) if f.endswith(".txt")]:
        shutil.copy(os.path.join(msgs, name), os.path.join(msgs, "more-" + name))
    third = run("jobs/stream.py", "--input", msgs, "--out", out, "--available-now")
    assert third.returncode == 0, third.stderr[-2000:]
    assert alerts() == 80
    # Another checkpoint would lose alerts without a word, so it is refused.
    other = run("jobs/stream.py", "--input", msgs, "--out", out, "--available-now", "--checkpoint", str(tmp_path / "new"))
    assert other.returncode != 0 and "another checkpoint" in other.stderr


def test_serve_train_and_sql_kpi_clis(base, tmp_path):
    serve = run("jobs/serve.py", "--kpis", f"{base}/kpis", "--out", str(tmp_path / "serve"))
    assert serve.returncode == 0, serve.stderr[-2000:]
    assert sorted(os.listdir(tmp_path / "serve")) == ["charts", "revenue_share_genre", "summary"]
    sql = run("jobs/sql_kpis.py", "--curated", f"{base}/curated", "--out", str(tmp_path / "sql"), "--show", "0")
    assert sql.returncode == 0, sql.stderr[-2000:]
    assert len(os.listdir(tmp_path / "sql")) == 8
    train = run("jobs/train.py", "--curated", f"{base}/curated", "--model", str(tmp_path / "model"))
    assert train.returncode == 0, train.stderr[-2000:]
    assert "rmse" in train.stdout and "intercept" in train.stdout
    assert os.path.isdir(tmp_path / "model" / "stages")


def test_stream_cli_with_shared_sinks_and_a_start_position(tmp_path):
    import json

    msgs, out, more = (str(tmp_path / n) for n in ("msgs", "alerts", "json"))
    assert run("jobs/publish.py", "--tables", SF_SMALL, "--out", msgs).returncode == 0
    args = ["jobs/stream.py", "--input", msgs, "--out", out, "--also", f"json={more}", "--console", "--available-now"]
    done = run(*args)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "Batch 0" in done.stdout and "hype_spike" in done.stdout
    lines = [json.loads(x) for d, _, names in os.walk(more) for n in names if n.endswith(".json") for x in open(os.path.join(d, n))]
    assert len(lines) == 40 and os.listdir(f"{out}_ledger") and os.path.exists(f"{out}_checkpoint_start")
    # From the files that come after the first start: none are there.
    late = run("jobs/stream.py", "--input", msgs, "--out", str(tmp_path / "late"), "--starting-files", "latest", "--available-now")
    assert late.returncode == 0, late.stderr[-2000:]
    assert not [f for f in os.listdir(tmp_path / "late") if f.endswith(".parquet") and os.path.getsize(tmp_path / "late" / f) > 5000]
