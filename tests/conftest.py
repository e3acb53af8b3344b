from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """``frame(schema, *rows)``: a DataFrame from literal rows."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import MapType, StructType

    def build(schema, *rows):
        if not isinstance(schema, StructType):
            schema = StructType.fromDDL(schema)
        if not rows or any(isinstance(f.dataType, MapType) for f in schema):
            return spark.createDataFrame(list(rows), schema)
        arrow = to_arrow_schema(schema)
        columns = [pa.array(list(c), type=f.type) for c, f in zip(zip(*rows), arrow)]
        return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)

    return build


def by(df, *keys):
    """Rows as ``key -> dict``; the key is a tuple when there are several columns."""
    rows = [r.asDict(recursive=True) for r in df.collect()]
    out = {row[keys[0]] if len(keys) == 1 else tuple(row[k] for k in keys): row for row in rows}
    assert len(out) == len(rows), "keys are not unique"
    return out
