import pytest

from lakeweir.llm.common import prepared

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id string, score int, size string"


@pytest.fixture(autouse=True)
def workers(spark):
    """Python workers can import the package."""
    prepared(lambda session: None)(spark)


@pytest.fixture
def frame(spark):
    """Documents from ``(doc_id, text, lang, source)``, with further columns whose names operators use too."""

    def make(rows):
        full = [(*r, *[None] * (4 - len(r))) for r in rows]
        return spark.createDataFrame([(i, t, lang, source, None, "x", 1, "y") for i, t, lang, source in full], DOCS)

    return make


@pytest.fixture
def awkward(frame):
    """Nulls, empty and very long texts, ties and repeated rows."""
    long_text = " ".join(f"word{i % 977} and the item{i % 31}" for i in range(30_000))
    return frame(
        [
            (1, "the quick brown fox jumps over the lazy dog", "en", "b"),
            (1, "the quick brown fox jumps over the lazy dog", "en", "b"),
            (2, None, None, None),
            (3, "", "en", "a"),
            (None, "a text that has no id at all but is one", None, "a"),
            (None, None, "xx", "c"),
            (4, " \t\n ", "en", None),
            (5, long_text, "en", "a"),
            (6, "###!!! 12 $$$", "de", "c"),
            (7, "der schnelle braune Fuchs springt über den faulen Hund", "de", "c"),
            (8, "x\x00y z 😀".encode("utf-16", "surrogatepass").decode("utf-16"), "en", "b"),
        ]
    )
