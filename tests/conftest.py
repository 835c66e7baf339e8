from __future__ import annotations

import pytest

from cyclewise.session import local_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def panel(spark):
    """Two units of 50 cycles, all 26 columns and labels."""
    import numpy as np

    from cyclewise.constants import OP_SETTINGS, SENSORS

    rng = np.random.default_rng(42)
    rows = []
    for unit in (1, 2):
        for cycle in range(1, 51):
            settings = [float(rng.normal(0, 0.002)), float(rng.normal(0, 0.0003)), 100.0]
            sensors = [float(rng.normal(500 + 10 * i, 5)) for i in range(1, 22)]
            rows.append((unit, cycle, *settings, *sensors, 50 - cycle, int(50 - cycle < 30)))
    names = [*OP_SETTINGS, *SENSORS]
    schema = (
        "unit_id long, time_cycles long, "
        + ", ".join(f"{c} double" for c in names)
        + ", rul long, is_anomaly int"
    )
    return spark.createDataFrame(rows, schema).persist()
