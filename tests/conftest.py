import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from patronage.session import build_session  # noqa: E402
from patronage.sources.sample_tables import SampleTables  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                            spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sample(spark):
    return SampleTables(spark, DATA)


@pytest.fixture(autouse=True)
def whole_plans(request):
    """op10_bpe cuts the text of plans short for the rest of its session; tests that read plans get them whole."""
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").conf.unset("spark.sql.maxPlanStringLength")
