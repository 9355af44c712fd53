import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"

# Names that the operators use inside, and one that needs quoting.
CLASHING = (
    "id n a b k c h g pos row rows line lines hash one keeper documents drops kept size queued "
    "shuffled copies target taken round finish weight limit ratio level left share nth part "
    "component root rep unit vector links block low high tokens offset loss_from loss_to chars "
    "label score predicted held base more all letters lang_pred items hits n_words n_hit "
    "_bucket _base _text _row _score _lines _drops _gone _told _g _b _sum col trees d1 d2"
).split() + ["dotted.name"]


@pytest.fixture(scope="session")
def clash():
    """Adds a column for every clashing name the frame does not have."""

    def add(frame):
        taken = {c.lower() for c in frame.columns}
        return frame.select("*", *(F.lit(c).alias(c) for c in CLASHING if c not in taken))

    return add


@pytest.fixture(scope="session")
def given(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@pytest.fixture(scope="session")
def texts(spark):
    """A frame ``doc_id, text, lang, source, n_chars`` from rows of id and text (and source)."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"

    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else None, None) for r in rows]
        return spark.createDataFrame(full, schema)

    return make


def collected(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
