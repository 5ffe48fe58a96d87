import pytest

SF = "/root/testdata/sf0.001"

EXTRA = "id long, key string, n_words string, ids string, twin int"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, and
    extra columns whose names the operators use themselves."""
    long = " ".join(f"w{i % 700} alpha{i % 13}" for i in range(20_000))
    near = " ".join(f"tok{i}" for i in range(200))
    rows = [
        (1, "", "en", "a"), (2, None, "en", None), (3, "one two", None, "b"), (4, near, "en", "a"),
        (5, near + " tail", "en", "a"), (5, near + " tail", "en", "a"), (None, near, "en", "b"), (6, "  \t\n ", "en", "a"),
        (7, long, "en", "c"), (8, "mail a.b@mail3.example.com, card 4041894974608795 and 4041894974608796", "en", None),
        (9, "mail a.b@mail3.example.com again 2001-02-29 2000-02-29", "en", "b"), (9, "other text of the same id", "en", "b"),
    ]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), 5, "x", "y", "z", 1) for r in rows],
                                 f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(1, 10)] + [(None, None, None)],
                                 "doc_id long, quality int, toxic int")
