import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from wayfare import schemas as S  # noqa: E402
from wayfare.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield session
    session.stop()


# One valid round trip.
FLIGHTS = [
    (1, 1, "Florianopolis (SC)", "Recife (PE)", "economic", 500.0, 2.5, 1000.0, "Rainbow", "01/01/2019"),
    (1, 1, "Recife (PE)", "Florianopolis (SC)", "economic", 500.0, 2.5, 1000.0, "Rainbow", "01/04/2019")]
HOTELS = [(1, 1, "Hotel A", "Recife (PE)", 3, 150.0, 450.0, "01/01/2019")]
USERS = [(1, "Acme Factory", "Alice Smith", "female", 30)]


@pytest.fixture
def raw(spark):
    rows = {"flights": FLIGHTS, "hotels": HOTELS, "users": USERS}
    return {name: spark.createDataFrame(rows[name], S.RAW[name]) for name in rows}


def day(text):
    return dt.date.fromisoformat(text)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
