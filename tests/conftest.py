import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from opinia.session import local_session  # noqa: E402

REVIEWS = [
    (1, "Crust is not good.", 0.0),
    (2, "Wow... Loved this place!", 1.0),
    (3, "The ravoli was overpriced, isn't it?", 0.0),
    (4, "  Two  spaces  and a co-op ", 1.0),
    (5, "", 0.0),
    (6, None, 1.0),
    (7, "Crème brûlée under_score", 1.0),
    (8, "Good good GOOD", 1.0),
    (9, "meh", 0.0),
]


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", "6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    return spark.createDataFrame(REVIEWS, "doc_id long, text string, label double")


@pytest.fixture(scope="session")
def reviews(raw):
    return raw.fillna("", ["text"]).cache()
