import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from carelake.session import get_spark

    s = get_spark("local[4]", 8, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt"))})
    yield s


@pytest.fixture(scope="session")
def wh_small(spark):
    from carelake import Warehouse
    from carelake.constants import ENGINEER_ROLE

    return Warehouse.from_testdata(spark, SF_SMALL, role=ENGINEER_ROLE)


def write_csv(path, header, rows, gz=False):
    """Write a landing file exactly as given (rows are raw text lines)."""
    import gzip

    text = "\n".join([header] + rows) + "\n"
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        with open(path, "w") as f:
            f.write(text)
    return path
