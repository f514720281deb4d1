import random

import pytest

from parcelle.llm.common import written

WORDS = "the of and to in tion ing her ent ion ter est are all ver men con pro str ive".split()
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row long, n long, kept boolean, start long, name string, path string")


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(WORDS, k=rng.randint(1, 3))) for _ in range(n))


def table(spark, rows):
    """A Parquet table of (doc_id, text, lang) with columns whose names the
    operators use inside."""
    wide = [(i, t, lang, "s", 7, 1, 2, True, 3, "x", "y") for i, t, lang in rows]
    return written(spark.createDataFrame(wide, SCHEMA), "fixture")


@pytest.fixture(scope="session")
def corpus():
    """Nulls, empty and blank texts, ties, repeated rows, copies, a NULL id,
    a long text, one long run without white space."""
    rng = random.Random(5)
    base = prose(rng, 300)
    rows = [(i, prose(rng, rng.randint(1, 90)), "en") for i in range(40)]
    rows += [(40, None, None), (41, "", "en"), (42, " \n\t ", None), (43, "12 34", "en"), (None, "null id", "en"), (44, "one two", "fr")]
    rows += [(50 + i, base, "en") for i in range(4)] + [(50, base, "en")]
    rows += [(60, base.upper(), "en"), (61, base + " one more word", "en"), (62, "x " + base[:700], "en")]
    rows += [(70, prose(rng, 6000), "en"), (71, "ab" * 3000, "en"), (72, "Erinsh. " * 200, "en")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return table(spark, corpus)


@pytest.fixture(scope="session")
def empty(spark):
    return table(spark, [])
