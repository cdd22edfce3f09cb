import pytest
from pyspark.sql import types as T


@pytest.fixture()
def docs(spark):
    """``docs([(id, text), ...])``: a documents table over several partitions
    with extra columns whose names clash with the operators' own."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType()), T.StructField("fp", T.StringType()),
                           T.StructField("rep", T.LongType())])

    def make(rows, langs=None, sources=None):
        full = [(i, t, (langs or {}).get(i), (sources or {}).get(i, "s0"), len(t) if t is not None else None, "x", -1)
                for i, t in rows]
        return spark.createDataFrame(full, schema).repartition(3)

    return make
