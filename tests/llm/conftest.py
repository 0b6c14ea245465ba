import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return; as extra columns they must do no harm.
CLASHING = (
    "ids size target taken score part block shard slot root hash side label key doc keep line site owner_id "
    "hit_lines fingerprint component_id mix_key mix_size source_size raw tail_probability vector estimate"
).split()


@pytest.fixture(scope="session")
def documents(spark):
    """Build documents from (doc_id, text, source) tuples; ``clash`` adds columns with awkward names."""

    def build(rows, clash=False):
        full = [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows]
        df = spark.createDataFrame(full, COLUMNS)
        return df.selectExpr("*", *[f"concat('own-', doc_id) as {c}" for c in CLASHING]) if clash else df

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977}" for i in range(120_000))
    return [
        (1, "alpha beta gamma delta epsilon\nshared line here", "a"),
        (2, "alpha beta gamma delta epsilon\nshared line here", "b"),
        (3, "other words stand here today\nshared line here", "c"),
        (3, "other words stand here today\nshared line here", "c"),
        (4, None, "a"),
        (5, "", "b"),
        (6, " \n\t ", None),
        (None, "a text without an id", "a"),
        (None, None, None),
        (7, long, "c"),
        (8, "naïve Ünïcode 日本語 😀 text", "c"),
    ]
