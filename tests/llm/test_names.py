"""Columns of any name beside those that an operator reads."""

import pytest

from seqframe.llm.decontamination import without_contaminated
from seqframe.llm.mixing import mixed_documents
from seqframe.llm.prefix_join import one_of_each
from seqframe.llm.repeats import without_repeats
from tests.llm.conftest import prose

NAMES = ["_row", "_h", "_spans", "_source_key", "_copy", "_id", "_again", "_bad", "_drawn", "_shard", "_place", "_h_", "c0", "c1", "row", "name"]


@pytest.mark.parametrize("work", [one_of_each, without_repeats, mixed_documents, "decontaminate"])
def test_helpers_never_touch_a_users_column(spark, work):
    rows = [(k, prose(k, 90), "en", "s", *(f"{n}{k}" for n in NAMES)) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id INT, text STRING, lang STRING, source STRING, " + ", ".join(f"`{n}` STRING" for n in NAMES))
    if work == "decontaminate":
        items = spark.createDataFrame([(1, prose(999, 30))], "item_id INT, text STRING")
        out = without_contaminated(df, items)
    else:
        out = work(df)
    assert out.columns[: len(df.columns)] == df.columns
    got = {tuple(r)[: len(df.columns)] for r in out.collect()}
    assert got <= set(rows) and len(got) >= 8
