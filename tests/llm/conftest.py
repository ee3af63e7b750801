import pytest
from pyspark.sql import functions as F

#: Nulls, empty and tiny texts, ties, repeated rows, long texts, and a column whose name operators also use.
AWKWARD = [(None, None, None), (1, "", "a"), (2, "a b", "a"), (2, "a b", "a"), (3, "x " * 4000, "b"), (4, "é ü\t\n\n", None),
           (5, "y" * 5000, "c"), (None, "a b", "b")]


@pytest.fixture(scope="session")
def awkward(spark):
    df = spark.createDataFrame(AWKWARD, "doc_id long, text string, source string")
    return df.withColumn("kept", F.lit("theirs")).withColumn("score", F.lit(1)).withColumn("key", F.lit(2))


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
