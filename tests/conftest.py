import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from kiln.session import get_session
    s = get_session("local[4]", app="kiln-tests", shuffle_partitions=4)
    yield s


@pytest.fixture()
def small_blocks(spark):
    """Force the multi-block series path (hot-key handling) on tiny data."""
    spark.conf.set("kiln.series.blockRows", "7")
    yield 7
    spark.conf.unset("kiln.series.blockRows")
