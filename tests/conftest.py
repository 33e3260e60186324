import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from goldkeep.operators import joins  # noqa: E402
from goldkeep.session import local_session  # noqa: E402
from goldkeep.shared import clear_scratch  # noqa: E402

SMALL = "/root/testdata/sf0.001"

#: Tram stops: one pair and one triple of copies, look-alikes, and members that are missing.
STOPS = [
    (3, "Harbour", "Ferry Pier", "coast"),
    (5, "Hillside", "Mill Pond", "valley"),
    (8, "Hillside", "Larch Row", "valley"),
    (9, "Hillside", "Larch Row", "valley"),
    (20, "Old Town", "Weir and Lock", "ring"),
    (21, "Old Town", "Weir and Lock", "ring"),
    (22, "Old Town", "Weir and Lock", "ring"),
    (30, "Old Town", "Lantern Street East", "ring"),
    (31, "Old Town", "Lantern Street West", "ring"),
    (44, "Hillside", "Upper Larch Row", "valley"),
    (70, "Unmapped", None, None),
    (71, None, "Beyond the ring", None),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        "tests",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def stops(spark):
    return spark.createDataFrame(
        STOPS, "stop_id bigint, district string, stop string, tier string"
    )


@pytest.fixture(params=["broadcast", "shuffle"])
def join_path(request, monkeypatch):
    """Run a test with small lookups broadcast, then as if every lookup were large."""
    if request.param == "shuffle":
        monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(joins, "heavy_limit", lambda spark: 2)
    return request.param


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
