"""Presences of few texts are held at a time, however many rows a task is handed."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from seqframe.llm import language_id as M


def test_no_more_texts_are_held_than_the_bound(monkeypatch):
    sizes, real = [], M.presence
    monkeypatch.setattr(M, "presence", lambda column: sizes.append(len(column)) or real(column))
    n = 2 * M.HELD + 7
    texts = [f"text {k % 50} of some words" if k % 2 else f"ein wort {k % 50} und mehr" for k in range(n)]
    langs = ["en" if k % 2 else "de" for k in range(n)]
    batch = pa.record_batch([pa.array(range(n)), pa.array(langs), pa.array(texts)], ["key", "lang", "text"])
    bits = [r for b in M._bits([batch]) for r in b.column("bits").to_pylist()]
    want = np.packbits(real(pa.array(texts)).astype(np.uint8), axis=1)
    assert bits == [r.tobytes() for r in want]
    model = SimpleNamespace(value=M.fit(want[:100], langs[:100]))
    out = pa.Table.from_batches(list(M._predicted(model)([pa.record_batch([pa.array(range(n)), pa.array(texts)], ["id", "text"])])))
    assert out.column("id").to_pylist() == list(range(n)) and out.column("lang_pred").to_pylist() == langs
    assert max(sizes) <= M.HELD


def test_stages_that_hand_on_whole_texts_do_so_in_small_batches(spark, docs, monkeypatch):
    import corpus_pipeline
    from seqframe.llm.batches import ROWS

    seen, real = [], corpus_pipeline.written
    monkeypatch.setattr(corpus_pipeline, "written", lambda df, *codec: seen.append(int(spark.conf.get(ROWS))) or real(df, *codec))
    table = docs(*((k, f"text {k} of some words", "en", "web") for k in range(9)))
    for stage in (corpus_pipeline.language_id, corpus_pipeline.suffix_array_dedup):
        assert stage(spark, table, "").count() == 9
    assert seen == [corpus_pipeline.ROWS_AT_A_TIME] * 2 and int(spark.conf.get(ROWS)) > corpus_pipeline.ROWS_AT_A_TIME
