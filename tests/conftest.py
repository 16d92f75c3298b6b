import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pricefold.session import get_session
    s = get_session("local[4]", app="pricefold-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="pricefold-test-ckpt-")})
    yield s


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="pricefold-test-")


def one_col(spark, values, expr_fn, dtype="string"):
    """Evaluate a Column function over a one-column frame, in input order."""
    from pyspark.sql import functions as F
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr_fn(F.col("v"))).collect()]
