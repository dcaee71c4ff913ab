"""Operator 10 reads texts once and writes as many tables however large the filter is."""

from collections import Counter

from seqframe.llm import lm_scoring
from tests.llm.conftest import ODD, prose


def test_tables_written_do_not_grow_with_the_filter(docs, monkeypatch):
    rows = [*ODD, *((200 + k, prose(k, 60, 4_000)) for k in range(40))]
    made, real = [], lm_scoring.written
    monkeypatch.setattr(lm_scoring, "written", lambda df, *codec: made.append(out := real(df, *codec)) or out)
    table = docs(*rows)
    scores = lambda: Counter((r.doc_id, round(r.score, 9), round(r.base_score, 9)) for r in lm_scoring.scored_corpus(table).collect())
    whole, few = scores(), len(made)
    made.clear()
    monkeypatch.setattr(lm_scoring, "SENT_BYTES", 4_096)
    assert scores() == whole and len(made) == few
    # Each row's tokens lie in one chunk, and a chunk has one answer at most from a bucket about an order.
    chunks, answers = made
    assert chunks.selectExpr("sum(size(ids))").first()[0] == len(rows)
    assert answers.groupBy("chunk", "bucket", "order").count().filter("count > 1").isEmpty()
