import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from harvestlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "harvestlens-tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def quotes_of(spark):
    """Raw quotes from short rows (state, market, commodity, day, min, modal, max)."""
    from harvestlens.schemas import RAW_QUOTE

    def make(rows):
        full = [
            (state, "district", market, commodity, "Local", "FAQ", day, str(low), str(high), str(modal))
            for state, market, commodity, day, low, modal, high in rows
        ]
        return spark.createDataFrame(full, RAW_QUOTE)

    return make


@pytest.fixture(scope="session")
def no_names(spark):
    return spark.createDataFrame([], "raw_name string, english_name string")
