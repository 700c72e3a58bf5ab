import duckdb
import pytest
from pyspark.sql import functions as F

DIR = "/root/testdata/sf0.01"

#: Names that the operators use inside or return.
CLASHING = ("kept", "score", "dk", "row", "line", "node", "n_words", "key", "root", "h", "name", "start", "toxic_")

LONG = "lorem " * 20_000 + "x" * 50_000 + " " + "7" * 5_000


def edge_rows():
    prose = "the cat sat on the mat and then it went out to the yard where the dog was " * 5
    return [
        (1, prose, "en"),
        (1, prose, "en"),  # a repeated row
        (2, prose, "en"),  # a copy
        (3, None, "en"),
        (4, "", "en"),
        (None, "kein wort ist hier zu viel und keines zu wenig", None),
        (None, None, None),
        (5, LONG, "en"),
        (6, " \t\n\x0b ", "fr"),
        (7, "a\n\na\n", ""),
        (8, "é😀 ünï\n" * 30, "de"),
        (9, "one two", "en"),
        (9, "two one", "en"),  # one id, two texts
    ]


@pytest.fixture(scope="session")
def edges(spark):
    df = spark.createDataFrame([(*r, "src", None) for r in edge_rows()], "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def empty(edges):
    return edges.where("false")


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    yield con
    con.close()


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{DIR}/labels.parquet")
