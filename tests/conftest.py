import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pathwise.session import local_session

    s = local_session("*", 8, app="pathwise-tests")
    yield s


@pytest.fixture(scope="session")
def refresh(spark):
    from pathwise.plans.catalog import refresh as make

    return make(spark, SF_SMALL)


@pytest.fixture(scope="session")
def base(spark, refresh):
    from pathwise.sources.publish import materialize, new_run_dir

    return materialize(refresh.pathway_base, f"{new_run_dir(spark, 'test')}/pathway_base")
