import math

import duckdb
import pytest

from dayloom import session
from dayloom.operators.spine import one_hot, register_type_categories
from dayloom.plans.queries import rounded
from sql_oracle import r6

VALUES = [1e13, 9.3e12, -9.3e12, 0.0, 1 / 3, 2.5e-7, 1.5e-6, -0.1234565, 123456.7890125, float("nan"), None]


def test_rounding_of_large_values_and_nan(spark):
    got = [r[0] for r in rounded(spark.createDataFrame([(v,) for v in VALUES], "x double")).collect()]
    want = [duckdb.execute(f"SELECT {r6('?')}", [v]).fetchone()[0] for v in VALUES]
    assert [repr(a) for a in got] == [repr(b) for b in want]
    assert got[0] == 1e13 and got[1] == 9.3e12 and math.isnan(got[-2]) and got[-1] is None


def test_null_and_odd_categories(spark):
    df = spark.createDataFrame([("10",), ("2",), (None,), ("it's",)], "register_type string")
    found = register_type_categories(df)
    assert found == ["10", "2", "it's"]
    rows = [tuple(r) for r in df.select(*one_hot("register_type", found, "c")).collect()]
    assert rows == [(1, 0, 0), (0, 1, 0), (0, 0, 0), (0, 0, 1)]


class _Conf(dict):
    def set(self, k, v):
        self[k] = v


class _Session:
    """What `ensure_checkpoint_dir` looks at."""

    def __init__(self, master, conf=(), folder=None):
        self.conf, self.sparkContext = _Conf(conf), self
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_checkpoint_folder():
    s = _Session("spark://host:7077", {"spark.checkpoint.dir": "hdfs:///shared"})
    assert session.ensure_checkpoint_dir(s) == s.folder == "hdfs:///shared"
    s = _Session("yarn", folder="hdfs:///given")
    assert session.ensure_checkpoint_dir(s) == "hdfs:///given"
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.ensure_checkpoint_dir(_Session(master))
    s = _Session("local[4]")
    assert session.ensure_checkpoint_dir(s) == s.folder == s.conf["spark.checkpoint.dir"]
