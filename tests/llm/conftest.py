import pytest

#: Null, empty, blank, short, tied and repeated rows, a long text, and columns whose names clash.
TEXTS = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one two three four"), (6, "one two three four five six"),
    (6, "one two three four five six"), (7, "One TWO three four five six"), (None, "one two three four five six"),
    (None, None), (8, "żółć ÀÉ 12 !"), (9, "word " * 30_000), (10, "word " * 30_000), (11, "\x00odd\x7f"),
    (12, "Zażółć gęślą jaźń i mail: a.b@c.de oraz +48 123 456 789"),
]
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key long, node long, score double, "
    "label int, n long, token long, row long, split int, length long"
)


@pytest.fixture(scope="session")
def edges(spark):
    rows = [(k, t, "en" if i % 3 else None, None if i % 2 else "a/test", None, 1, 2, 0.5, 3, 4, 5, 6, 7, 8) for i, (k, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def tables(spark, tmp_path, edges):
    """A folder of tables over the edge rows."""

    def write(**frames):
        frames.setdefault("documents", edges)
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
