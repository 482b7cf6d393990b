import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from farestrata import refs, session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    built = session.build(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture(scope="session")
def zones(spark):
    rows = [(i, "Queens", f"Zone {i}", "Boro Zone") for i in (1, 2, 3, 132, 138)]
    rows += [(264, "Unknown", "N/A", "N/A"), (265, "N/A", "Outside of NYC", "N/A")]
    return spark.createDataFrame(rows, "locationid bigint, borough string, zone string, service_zone string")


@pytest.fixture(scope="session")
def references(spark, zones):
    from farestrata.operators import silver

    return refs.builtin(spark, silver.clean_zones(zones))
