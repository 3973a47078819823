import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, shard string, slot string, "
          "fingerprint string, component_id string, score string, predicted string, spans string, overlaps string, "
          "n_tokens string, probability string, sampled string, runs string, kept string, kept_text string, "
          "n_lines string, n_removed string, n_bytes string, n_spans string, c0 string, id string, th string, host string")
EXTRA = 22
LONG = "palabra larga " * 30_000


def rows_with_extras(rows):
    return [(*r, *[f"x{i}" for i in range(EXTRA)]) for r in rows]


#: Nulls in every column, empty and very long texts, ties, repeated rows, repeated ids.
EDGE = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here today.", "en", "a", 10),
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here today.", "en", "a", 10),
    (2, "", "en", "a", 0),
    (3, None, None, None, None),
    (None, "A text without an id, long enough to hold several words and some more of them.", "de", None, 5),
    (None, None, None, None, None),
    (4, LONG, "es", "b", len(LONG)),
    (5, LONG, "es", "b", len(LONG)),
    (5, "another text under a used id\nwith a second line\nand a third", "es", "b", 3),
    (6, " \n\t\n ", "en", "c", 5),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(rows_with_extras(EDGE), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs."""
    def build(pairs, **columns):
        rows = [(i, t, columns.get("lang", "en"), columns.get("source", "a"), len(t or "")) for i, t in pairs]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return build
