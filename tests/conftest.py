from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from tripfold.session import build_session  # noqa: E402
from tripfold.sources.staging import SHARED_FOLDER  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {"spark.ui.enabled": "false", "spark.driver.memory": "4g"}
    session = build_session("tests", "local[8]", shuffle_partitions=4, **settings)
    if not session.conf.get(SHARED_FOLDER, None):  # only where none is named
        session.stop()
        settings[SHARED_FOLDER] = str(tmp_path_factory.mktemp("shared"))
        session = build_session("tests", "local[8]", shuffle_partitions=4, **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_DIR).exists():
        pytest.skip("test tables are not here")
    return SF_DIR


@pytest.fixture(scope="session")
def trips(spark, sf_dir, tmp_path_factory):
    """Trips of the smallest scale, written once."""
    from tripfold.sources.staging import materialised
    from workbench import tables

    folder = tmp_path_factory.mktemp("trips")
    return materialised(tables.trips(spark, sf_dir), f"{folder}/trips")


@pytest.fixture(scope="session")
def zones(spark, sf_dir):
    from workbench import tables

    return tables.zones(spark, sf_dir)


@pytest.fixture
def setting(spark):
    """Change session settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)
