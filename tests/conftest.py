import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from fragloom.session import build_session
    session = build_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
                                "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def fragments(spark):
    """Four fragments over three bins, one of them across a bin edge."""
    rows = [("s1", "chr1", 10, 50, 60, "+", 40), ("s1", "chr1", 90, 110, 60, "+", 20),
            ("s1", "chr1", 100, 170, 60, "-", 70), ("s1", "chr2", 5, 140, 60, "+", 135)]
    return spark.createDataFrame(
        rows, "sample_id string, chrom string, start bigint, `end` bigint, mapq bigint, strand string, length bigint")
