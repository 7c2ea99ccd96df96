import pytest
from pyspark.sql import types as T

from veracat.llm.common import settings

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session", autouse=True)
def small_batches(spark):
    settings(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """Builds documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1]) if r[1] else None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


def prose(seed: int, n: int) -> str:
    """n invented words with sentences, the same for the same seed."""
    import random

    draw = random.Random(seed)
    made = ["".join(draw.choice(["ka", "lo", "mi", "ne", "su", "ra", "to"]) for _ in range(draw.randint(1, 4))) for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(made))


@pytest.fixture(scope="session")
def odd(documents):
    """NULLs in every column, empty, blank and very long texts, ties and repeated rows."""
    long_ = prose(1, 6_000)
    return documents([
        (1, None), (None, None), (2, ""), (3, " \t\n "), (4, long_, "en", "a"), (5, long_, "en", None), (5, long_, "en", None), (None, prose(2, 40), None, "b"),
        (None, prose(2, 40), None, "b"), (6, prose(3, 3), "de", ""), (7, "\n".join([prose(4, 30)] * 3), "de", "a"), (8, "é\U0001F600 " * 12, None, None), (-9, "12 34 !!", "fr", "c"),
    ])


@pytest.fixture(scope="session")
def none(documents):
    return documents([])


def clashing(df):
    """The frame with extra columns under the names that operators use inside or add."""
    from pyspark.sql import functions as F

    names = "row digest copies target size drawn its_id n_words kept class_id n_links root set_id lang_pred score h place slot line doc of_doc block lift items n_hit w t its_digest times cuts".split()
    return df.withColumns({n: F.lit(1) for n in names})
