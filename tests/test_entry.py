"""The entry point and the work folder where something is missing."""

import os
import subprocess
import sys

import pytest

from tradewharf import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["ahocorasick", "tokenizers", "tradewharf.llm"])
def test_entry_without_a_package(missing):
    """Without a package of the optional subpackage all other queries are there."""
    code = f"""
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as e
names, sql = e.queries(), e.oracle_sql()
assert len(names) >= 179 and set(sql) <= set(names), len(names)
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    if missing != "tokenizers":  # imported by the workers only
        assert "left out" in done.stderr


class _Fake:
    def __init__(self, spark, master, **conf):
        self._jvm, self._jsc = spark._jvm, spark._jsc
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, *default: conf.get(key.split(".")[-2], *default))})


def test_work_folder_is_shared(spark):
    """The named folder wins; a local warehouse is refused where executors have their own disks."""
    assert session.work_root(_Fake(spark, "spark://m:7077", checkpoint="hdfs://nn/work/")) == "hdfs://nn/work"
    assert session.work_root(_Fake(spark, "local[8]", checkpoint=None, warehouse="/tmp/w")) == "/tmp/w/_work"
    for master in ("spark://m:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.work_root(_Fake(spark, master, checkpoint=None, warehouse="file:/tmp/w"))
