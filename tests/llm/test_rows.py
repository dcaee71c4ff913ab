"""Rows, not ids, are kept or dropped: repeated rows, equal ids and null ids."""

from collections import Counter

from seqframe.llm.decontamination import without_contaminated
from seqframe.llm.prefix_join import one_of_each
from tests.llm.conftest import prose


def test_one_row_of_each_class_stays(docs):
    a, b, c, d = (prose(k) for k in range(70, 74))
    df = docs(
        *[(1, a)] * 3,  # a repeated row
        (2, b), (2, c), (3, b + " tail"),  # an id of two texts, and a near copy of one
        (None, d), (None, d), (None, d + " tail"),  # null ids: equal rows and a near copy
        (None, a), (9, c + " tail"),  # a null id gives way to another
        (4, None), (4, None), (None, ""), (None, ""),  # without shingles
    )
    kept = one_of_each(df)
    assert kept.columns == df.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    of_d = got[None, d], got[None, d + " tail"]
    assert sorted(of_d) == [0, 1]
    assert of_d == [(r[None, d], r[None, d + " tail"]) for r in [Counter((x.doc_id, x.text) for x in one_of_each(df.orderBy("text")).collect())]][0]
    assert {k: n for k, n in got.items() if n and k[1] not in (d, d + " tail")} == {(1, a): 1, (2, b): 1, (2, c): 1, (4, None): 2, (None, ""): 2}


def test_repeated_row_reaches_the_corpus(spark, docs):
    import corpus_pipeline

    df = docs((1, prose(75)), (1, prose(75)), (2, prose(76)))
    kept = corpus_pipeline.suffix_array_dedup(spark, corpus_pipeline.ngram_jaccard_join(spark, df, ""), "")
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, prose(75)), (2, prose(76))]


def test_only_rows_with_an_item_go(docs, spark):
    table = spark.createDataFrame([(0, prose(900, 30, 10**6))], "item_id BIGINT, text STRING")
    held = prose(900, 30, 10**6)
    df = docs((1, held), (1, "clean"), (None, held), (None, prose(7)), (None, prose(7)), (None, None), (2, held), (2, held))
    got = Counter((r.doc_id, r.text) for r in without_contaminated(df, table).collect())
    assert got == {(1, "clean"): 1, (None, prose(7)): 2, (None, None): 1}
