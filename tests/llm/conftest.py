import pytest

from plumbline.session import stored

COLUMNS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, score double, rank int, fp bigint, "
           "row string, _label int, shard int, ids string, words string, n bigint, label string, kept string, pos bigint")
ROWS = [
    (1, "a b c d e f g h i j k l m n o p q r s t u v", "en"), (1, "a b c d e f g h i j k l m n o p q r s t u v", "en"),
    (None, None, None), (None, "hello " * 30, None), (3, "", "de"), (4, "  \n ", "de"), (5, "x " * 30000, "fr"),
    (6, "Hello wörld 123", "en"), (7, "123 456", None), (8, None, "en"), (None, "you idiot scum", "en"),
    (9, "a" * 90000, "en"),
]


@pytest.fixture(scope="session")
def shared(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return spark


@pytest.fixture(scope="session")
def odd(shared):
    """Nulls, empty and very long texts, repeated rows and ids, and columns that clash with the operators' own."""
    return stored(shared.createDataFrame(
        [(i, t, lang, "s", 1, 1.0, 1, 1, "r", 0, 2, "i", "w", 1, "z", "k", 3) for i, t, lang in ROWS], COLUMNS))


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(shared, folder):
    return sorted((r["doc_id"], r["text"], r["lang"]) for r in shared.read.parquet(f"{folder}/documents.parquet").collect())
