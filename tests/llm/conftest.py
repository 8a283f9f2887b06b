import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
PROSE = {
    "en": "the river runs past the old mill and the fields where children played until the evening bell rang out",
    "de": "der Fluss fließt an der alten Mühle vorbei und über die Wiesen auf denen die Kinder bis zum Abend spielten",
}
#: Names that operators use for results or inside.
CLASHES = "row key slot position shard ids secrets held_out found fp sketch h d root block _at _block _g0 label".split()


def edge_rows():
    """Null, empty, blank and letterless texts, one very long, ties, repeated rows, nulls in every column."""
    long = " ".join(f"{PROSE['en']} {i}" for i in range(4000))
    rows = [
        (1, PROSE["en"], "en", "a", None),
        (2, PROSE["en"], "en", "a", len(PROSE["en"])),
        (3, PROSE["de"], "de", "b", len(PROSE["de"])),
        (3, PROSE["de"], "de", "b", len(PROSE["de"])),  # a repeated row
        (4, None, "en", "a", None),
        (5, "", None, None, 0),
        (6, " \n\t ", "de", "b", 4),
        (7, "12345 !!! 678", "en", "a", 13),
        (None, PROSE["de"] + " " + PROSE["de"], "de", None, None),
        (None, None, None, None, None),
        (8, long, "en", "c", len(long)),
        (9, "word", "en", "c", 4),
        (10, PROSE["en"] + " and so the day came to its end", None, "a", 1),
    ]
    return [tuple(r) for r in rows]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3, "doc_id")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(edges):
    from pyspark.sql import functions as F

    return edges.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def local_documents(documents):
    return documents.toPandas().sort_values("doc_id").reset_index(drop=True)
