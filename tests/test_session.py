"""Settled data is deleted by whoever owns it, in every thread and at the end of the process."""

import os
import subprocess
import sys
import threading

import pytest

from rosterflow import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROGRAM = """
import sys, threading
from rosterflow.session import build_session, scratch, settle
spark = build_session("owner", "local[2]", spark__ui__enabled="false", spark__checkpoint__dir=sys.argv[1], spark__ui__showConsoleProgress="false")
kept = settle(spark.range(5))
with scratch():
    outer = settle(spark.range(3), outlives=True)
    settle(spark.range(2))
def batch():
    settle(spark.range(7))
    with scratch():
        settle(spark.range(1))
thread = threading.Thread(target=batch)
thread.start(); thread.join()
assert kept.count() == 5 and outer.count() == 3
if sys.argv[2] == "stop":
    spark.stop()
elif sys.argv[2] == "fail":
    raise SystemExit(3)
"""


def _left(folder):
    return [f for _, _, files in os.walk(folder) for f in files]


@pytest.mark.parametrize("end", ["stop", "exit", "fail"])
def test_nothing_is_left_when_the_process_ends(tmp_path, end):
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM, str(tmp_path / "shared"), end], env={**os.environ, "PYTHONPATH": ROOT}, cwd=tmp_path, timeout=300, capture_output=True, text=True
    )
    assert done.returncode == (3 if end == "fail" else 0), done.stderr
    assert _left(tmp_path / "shared") == []


def test_each_thread_owns_what_it_settles(spark):
    inside, checked, told = threading.Event(), threading.Event(), {}

    def other():
        with session.scratch():
            told["df"] = session.settle(spark.range(4))
            inside.set()
            checked.wait(60)
            told["count"] = told["df"].count()

    thread = threading.Thread(target=other)
    with session.scratch():
        thread.start()
        assert inside.wait(60)
        session.settle(spark.range(2))
    # The end of one thread's block leaves the other's data alone.
    checked.set()
    thread.join()
    assert told["count"] == 4
    with pytest.raises(Exception):
        told["df"].collect()


class _Cluster:
    """What shared_dir asks of a session."""

    def __init__(self, master, warehouse, checkpoint=None):
        values = {"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": checkpoint}
        self.conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: values.get(k) or d)})
        self.sparkContext = type("Context", (), {"master": master, "getConf": staticmethod(lambda: self.conf)})


def test_a_local_folder_is_refused_on_a_cluster():
    assert session.shared_dir(_Cluster("local[4]", "file:/w")) == "file:///w"
    assert session.shared_dir(_Cluster("yarn", "hdfs://n/w")) == "hdfs://n/w"
    assert session.shared_dir(_Cluster("yarn", "file:/w", "s3a://b/c/")) == "s3a://b/c"
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        for place in ("file:/w", "/w"):
            with pytest.raises(RuntimeError):
                session.shared_dir(_Cluster(master, place))
