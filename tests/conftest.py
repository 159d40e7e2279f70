import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from carelake.session import build_session
    s = build_session("local[*]", app="carelake-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="carelake-test-wh-")})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="carelake-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from tests.fixtures import domain_tables
    return domain_tables(spark)


@pytest.fixture(scope="session")
def docs(spark, tables):
    from carelake.plans.document import build_documents
    from tests.fixtures import AS_OF
    return build_documents(tables, AS_OF).cache()
