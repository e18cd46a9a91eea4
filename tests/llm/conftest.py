import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def documents(spark):
    """All texts of the smallest table with the odd cases added, and columns whose names operators use inside."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    first = rows[0][1]
    rows += [(None, None), (None, ""), (None, first), (900_001, None), (900_002, ""), (900_003, " \t\n"),
             (900_004, first), (900_004, first), (900_004, first + " more"), (-5, "one"), (900_005, "two words"),
             (900_006, "of " * 60_000), (900_007, "x" * 70_000), (900_008, (first + " ") * 40)]
    df = spark.createDataFrame([(*r, 1, "a", 2, "b") for r in rows],
                               DOCS + ", rank int, digest string, key int, starts string").repartition(5)
    yield df.cache(), rows
    df.unpersist()  # tests of the library count cached tables


@pytest.fixture()
def no_documents(spark):
    return spark.createDataFrame([], DOCS)
