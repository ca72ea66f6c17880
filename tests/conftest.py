import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import cloudpickle  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import workload  # noqa: E402

cloudpickle.register_pickle_by_value(workload)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        # Small batches, so that state has to survive from one to the next.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
