import json

import pytest
from pyspark.sql import functions as F

from gatewright.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=8, memory="6g")


@pytest.fixture()
def messages(spark):
    """Messages from ``(direction, payload)`` pairs; dicts become JSON text."""

    def build(*rows, **columns):
        data = []
        for i, row in enumerate(rows):
            direction, payload = row if isinstance(row, tuple) else ("REQUEST", row)
            if isinstance(payload, (dict, list)):
                payload = json.dumps(payload)
            data.append((i, direction, payload))
        df = spark.createDataFrame(data, "msg_id long, direction string, payload string")
        for name, value in columns.items():
            df = df.withColumn(name, value)
        return df

    return build


@pytest.fixture()
def chat():
    def build(text, **more):
        return {"model": "m", "messages": [{"role": "system", "content": "s"},
                                           {"role": "user", "content": text}], **more}

    return build


@pytest.fixture()
def values(spark):
    """Values of a column function over a list of texts."""

    def run(texts, function):
        df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
        rows = df.select("i", function(F.col("t")).alias("v")).orderBy("i").collect()
        return [r.v for r in rows]

    return run


def rows(df, *columns):
    return [tuple(r) for r in df.orderBy("msg_id").select(*columns).collect()]


def outcomes(df):
    return [r.outcome for r in df.orderBy("msg_id").select("outcome").collect()]
