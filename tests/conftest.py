import glob
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
DATA = os.environ.get("TEST_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from archivelens.session import session

    s = session("local[8]", shuffle_partitions=4, **{"spark_ui_enabled": "false", "spark_driver_memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def duck(sf):
    import duckdb

    c = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def canonical_rows(df):
    """Rows as sorted strings, columns in order of their names, floats to nine places."""
    import pandas as pd

    out = []
    names = sorted(df.columns)
    for row in df[names].itertuples(index=False):
        cells = []
        for v in row:
            if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
                cells.append(str(list(v)))
            elif v is None or pd.isna(v):
                cells.append("-")
            elif isinstance(v, bool) or type(v).__name__ in ("bool_", "bool"):
                cells.append(str(bool(v)))
            elif isinstance(v, (int, float)) or hasattr(v, "dtype") or type(v).__name__ == "Decimal":
                cells.append(f"{float(v):.9g}")
            else:
                cells.append(str(v))
        out.append("|".join(cells))
    return names, sorted(out)
