import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from assayworks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="assayworks-warehouse-")
    session = local_session("assayworks-tests", cores=4, shuffle_partitions=4,
                            extra={"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
