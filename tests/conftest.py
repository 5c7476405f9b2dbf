import datetime as dt
import os
import pathlib
import sys

import numpy as np
import pandas as pd
import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from barloom import build_session  # noqa: E402
from barloom.schema import BARS  # noqa: E402

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")
GOLDEN_DIR = os.environ.get("GOLDEN_BARS_DIR", "")


def pytest_collection_modifyitems(config, items):
    """Tests of a real price history are only chosen where one is named."""
    if not GOLDEN_DIR:
        golden = [i for i in items if {"golden_bars", "golden_index"} & set(getattr(i, "fixturenames", ()))]
        config.hook.pytest_deselected(items=golden)
        items[:] = [i for i in items if i not in golden]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    path = f"{TESTDATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path


@pytest.fixture(scope="session")
def golden_bars(spark):
    """A real index history of 2014 and 2015, from the folder named in the environment."""
    from barloom.sources.files import read_price_csv

    found = sorted(pathlib.Path(GOLDEN_DIR).rglob("stock_*.csv"))
    return read_price_csv(spark, str(found[0])).cache()


def weekdays(n: int, start=dt.date(2019, 1, 1)):
    out, day = [], start
    while len(out) < n:
        if day.weekday() < 5:
            out.append(day)
        day += dt.timedelta(1)
    return out


def walk(code: str, n: int, seed: int, flat_from: int | None = None) -> list[tuple]:
    """A random walk whose adjusted close differs from the close, with some zero volumes."""
    rng = np.random.RandomState(seed)
    close = np.exp(np.cumsum(rng.normal(0, 0.02, n))) * 100
    rows = []
    for i, day in enumerate(weekdays(n)):
        c = float(close[i])
        o, h, l = c * (1 + rng.normal(0, 0.005)), c * (1 + abs(rng.normal(0, 0.01))), c * (1 - abs(rng.normal(0, 0.01)))
        h, l = max(o, h, c), min(o, l, c)
        v = float(rng.randint(0, 1000)) if rng.rand() > 0.1 else 0.0
        if flat_from is not None and i >= flat_from:
            o = h = l = c = rows[-1][5] if rows else 100.0
        rows.append((code, day, o, h, l, c, v, c * 0.9))
    return rows


LENGTHS = {"A": 1, "B": 2, "C": 14, "D": 15, "E": 16, "F": 33, "G": 34, "H": 60, "I": 300}


@pytest.fixture(scope="session")
def walks(spark):
    rows = []
    for k, (code, n) in enumerate(LENGTHS.items()):
        rows += walk(code, n, k)
    rows += walk("Z", 80, 99, flat_from=30)
    rng = np.random.RandomState(1)
    rng.shuffle(rows)
    rows = [tuple(r) for r in rows]
    rows = [(str(r[0]), r[1], *map(float, r[2:])) for r in rows]
    return spark.createDataFrame(pd.DataFrame(rows, columns=BARS.fieldNames()), BARS).repartition(5).cache()


@pytest.fixture(scope="session")
def walk_rows(walks):
    pdf = walks.toPandas().sort_values(["code", "date"])
    return {code: g.reset_index(drop=True) for code, g in pdf.groupby("code")}
