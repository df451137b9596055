import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tempoflow import schema as S  # noqa: E402
from tempoflow.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_tracks(spark):
    """Frame of tracks from dictionaries; ``seq`` counts up unless given."""
    columns = "seq long, name string, artist string, popularity int, danceability double, energy double, tempo double, timestamp timestamp"

    def make(rows):
        names = [part.split()[0] for part in columns.split(", ")]
        return spark.createDataFrame([tuple({"seq": i, **row}.get(n) for n in names) for i, row in enumerate(rows)], columns)

    return make


@pytest.fixture
def defaults():
    return S
