import pytest

from pyspark.sql import functions as F

#: a column of each name that the operators use inside
CLASHING = ("id", "row", "key", "c", "n", "h", "text2", "size", "spans", "n_words", "found", "component", "_w", "_t", "words", "held",
            "host", "slots", "code", "block", "kind", "blob", "copy", "place", "rate", "conv", "at", "seq", "bad", "rep", "same",
            "_new", "_spans", "_found", "_key", "_dropped", "_bad_key", "d", "own_key", "part", "mask", "ids", "chunk", "pos", "c1")


@pytest.fixture(scope="session")
def wide():
    """Adds columns that operators must not stumble over."""
    def add(df):
        return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING) if c not in df.columns])
    return add


@pytest.fixture(scope="session")
def docs(spark):
    """Documents of ``(doc_id, text)`` or ``(doc_id, text, lang, source)``."""
    def make(rows):
        rows = [(*r, "en", "s")[:2] + ((r[2], r[3]) if len(r) == 4 else ("en", "s")) for r in rows]
        return spark.createDataFrame([(i, t, la, s, None if t is None else len(t)) for i, t, la, s in rows],
                                     "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return make


def by_id(df, key="doc_id"):
    return sorted(df.collect(), key=lambda r: (r[key] is not None, r[key]))
