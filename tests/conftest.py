import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from hirewire.session import get_spark

    s = get_spark("local[4]", 4, app_name="hirewire-tests",
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="hw-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *cols):
    return [tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()]
