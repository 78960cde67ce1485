import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from claimweave.session import build_session

    session = build_session("local[8]", "tests", spark__ui__enabled="false",
                            spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
                            spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_limit(spark):
    """Treat keys with more than a few rows or pairs as hot, so the spreading joins are used."""
    from claimweave.operators.skew import PAIR_LIMIT_SETTING, ROW_LIMIT_SETTING

    spark.conf.set(ROW_LIMIT_SETTING, "3")
    spark.conf.set(PAIR_LIMIT_SETTING, "9")
    yield
    spark.conf.unset(ROW_LIMIT_SETTING)
    spark.conf.unset(PAIR_LIMIT_SETTING)
