import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "the an re er in st on th ea ou ti or ed ha sh le mo ka".split()


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices(SYLLABLES, k=r.randint(2, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source)."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty, white space only, very long, equal and repeated rows."""
    long = "\n".join(prose(i, 40) for i in range(500))
    return make_docs([
        (1, None), (2, ""), (3, " \n\t "), (4, long), (5, prose(1, 60)), (6, prose(1, 60)), (6, prose(1, 60)),
        (None, prose(2, 60)), (None, None), (7, "one"), (8, prose(3, 60), None), (9, "x" * 50_000),
        (10, "7" * 30_000), (11, "a@" * 5_000), (12, "++" * 5_000 + "(" * 5_000)])


# Names that operators use themselves.
CLASHING = ("id text_ row key size digest component_id _id _text kept host lines gone start at rank slot number "
            "bucket source_size target words n_words features band signature plain").split()


@pytest.fixture(scope="session")
def with_clashes():
    """The same rows with extra columns."""
    from pyspark.sql import functions as F

    return lambda df: df.withColumns({c: F.lit(c) for c in CLASHING})


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


@pytest.fixture(scope="session")
def rows():
    return rows_of


@pytest.fixture(scope="session")
def text_of_words():
    return prose
