import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import facility_rows  # noqa: E402
from facilitymetrics.plans.curate import curate  # noqa: E402
from facilitymetrics.schemas import PBJ, PROVIDER_INFO  # noqa: E402
from facilitymetrics.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def shared_dir(tmp_path_factory):
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def spark(shared_dir):
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": shared_dir,
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def refined_pbj(spark):
    return facility_rows.refined_pbj(spark)


@pytest.fixture(scope="session")
def refined_provider(spark):
    return facility_rows.refined_provider(spark)


@pytest.fixture(scope="session")
def pbj(refined_pbj):
    return curate(refined_pbj, PBJ)


@pytest.fixture(scope="session")
def provider(refined_provider):
    return curate(refined_provider, PROVIDER_INFO)
