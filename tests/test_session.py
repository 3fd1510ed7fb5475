import os
import subprocess
import sys
from types import SimpleNamespace

import pytest
from pyspark import cloudpickle

from trendloom.session import scratch_root


def session(master, checkpoint=None, app="app-1"):
    conf = SimpleNamespace(get=lambda key, default: checkpoint if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=app))


def test_the_shared_folder_of_the_cluster_is_used():
    assert scratch_root(session("yarn", "hdfs://lake/cp/")) == "hdfs://lake/cp/app-1"
    assert scratch_root(session("local[4]", "/shared")) == "/shared/app-1"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        scratch_root(session("yarn"))


def test_local_mode_keeps_one_folder_per_application():
    first = scratch_root(session("local[2]", app="unit-a"))
    assert first == scratch_root(session("local[2]", app="unit-a"))
    assert first.startswith("/tmp/run-") and first != scratch_root(session("local[2]", app="unit-b"))


def test_worker_functions_need_no_installed_package():
    from trendloom.operators.vectors import _unit

    code = "import numpy, pickle, sys; print(pickle.load(sys.stdin.buffer)(numpy.array([[3.0, 4.0]])))"
    done = subprocess.run(
        [sys.executable, "-c", code], input=cloudpickle.dumps(_unit), cwd="/tmp",
        capture_output=True, timeout=60, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
    )
    assert b"[[0.6 0.8]]" in done.stdout, done.stderr
