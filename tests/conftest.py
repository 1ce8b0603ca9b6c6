import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerloom.session import local_session

    warehouse = tmp_path_factory.mktemp("warehouse")
    return local_session("4", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": str(warehouse),
    })
