import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shardload.session import checkpoint_dir, get_spark, purge_scratch
    scratch = tempfile.mkdtemp(prefix="shardload-test-")
    s = get_spark("local[4]", 4, extra={"spark.driver.memory": "8g", "spark.local.dir": scratch})
    checkpoint_dir(s, fallback_root=os.path.join(scratch, "ckpt"))
    yield s
    purge_scratch(s)
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="shardload-case-")


def lines_df(spark, lines):
    from shardload.sources.lines import with_doc_key
    return with_doc_key(spark.createDataFrame([(l,) for l in lines], "value string"), spread=False)
