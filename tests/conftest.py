import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from runlens.session import get_spark

    import tempfile

    warehouse = tempfile.mkdtemp(prefix="runlens-wh-")
    s = get_spark("local[4]", shuffle_partitions=4,
                  conf={"spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC",
                        "spark.sql.warehouse.dir": warehouse})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns when none given)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
