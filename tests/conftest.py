import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ratecraft.session import local_session, shared_dir
    s = local_session()
    shared_dir(s)   # spark.checkpoint.dir from the session; a private folder only if unset
    yield s
    s.stop()


@pytest.fixture(scope="session")
def features_small(spark):
    from ratecraft.plans.features import feature_table
    return feature_table(spark, SF_SMALL).cache()
