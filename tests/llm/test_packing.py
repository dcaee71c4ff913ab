"""Packing against the library's ids and the limits."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from seqframe.llm.packing import Limits, packed
from seqframe.llm.token_ids import Encoder, Ids, definition_of
from tests.llm.conftest import ODD, SCHEMA, prose

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
STRANGE = [
    "don't l'eau (foo) a<|endoftext|>b <|ENDOFTEXT|> x",
    "naïve café, É! ñ; ×x ÷, ç'est",
    "é, x́y ź! ȩ́,",
    "€, “quoted”—dash… a b　c \x1cd",
    "ΑΣ ΣΑΣ, ΑΣ. 's 't !'s x'll's 123abc456,7.8 İstanbul, ß? ǅ à'",
    "ＡＢＣ, ①② <|startoftext|> 각, 한글! ab‍, ﻿x 🙂🙂,🙂",
]


def whole(path):
    encode = Encoder(definition_of(path))
    return lambda text: [*encode([text or ""])[0], 2]


def check(rows, got, path=WORDS, limits=Limits(), prompts=None):
    """Each id lies in one piece, sequences are gapless and within the limits; returns padding and ids in all."""
    ids, left = whole(path), Counter()
    for i, text in rows:
        prompt = ids(prompts[i])[:-1] if prompts else []
        left[i, tuple(prompt + ids(text)), len(prompt)] += 1
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id, r.doc_tokens].append(r)
    for (i, tokens, silent), times in left.items():
        starts = Counter()
        for r in pieces[i, len(tokens)]:
            part = np.array(tokens[r.start : r.start + r.length], "<u4")
            if zlib.crc32(part.tobytes()) == r.ids_crc32:
                starts.update(range(r.start, r.start + r.length))
                if "ids" in r:
                    assert r.ids == part.tolist()
                if prompts:
                    assert r.loss_tokens == max(0, r.start + r.length - max(r.start, silent))
        assert starts == Counter({k: times for k in range(len(tokens))})
    assert sum(r.length for r in got) == sum(len(t) * n for (_, t, _), n in left.items())
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
    padding = 0
    for each in sequences.values():
        at = 0
        for r in sorted(each, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= limits.tokens and len(each) <= limits.segments and sum(r.loss_tokens for r in each) <= limits.loss
        padding += limits.tokens - at if at & (at - 1) else 0
    return padding, sum(r.length for r in got)


def test_ids_of_pieces_equal_the_library():
    import pyarrow as pa

    for path in (WORDS, BYTES):
        encode = Encoder(definition_of(path))
        for bound in (1_000_000, 3):
            known, texts, got = Ids(definition_of(path), bound), [*STRANGE, None, "", prose(1, 5_000), *STRANGE], []
            for ids, edges in known.blocks(pa.array(texts)):
                got += [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            assert got == encode([t or "" for t in texts])


def test_packed_documents(docs):
    rows = [*ODD, *((20 + k, t) for k, t in enumerate(STRANGE)), *((100 + k, prose(k, 20 + 37 * k)) for k in range(120))]
    got = packed(docs(*rows), WORDS).collect()
    padding, tokens = check(rows, got)
    assert padding < 0.005 * tokens


def test_limits_hold_together(docs):
    limits = Limits(tokens=512, segments=3, loss=300)
    rows = [*ODD, *((100 + k, prose(k, 1 + 7 * (k % 40))) for k in range(150))]
    check(rows, packed(docs(*rows), WORDS, limits=limits, window=32).collect(), limits=limits)
    check(rows, packed(docs(*rows), WORDS, limits=Limits(64, 1, 8), window=2).collect(), limits=Limits(64, 1, 8))


def test_prompts_bear_no_loss(spark):
    rows = [(k, prose(k, 5 + k)) for k in range(60)] + [(70, None), (71, prose(3, 900))]
    prompts = {i: prose(500 + i, (i * 13) % 90) for i, _ in rows} | {70: prose(9, 700)}
    table = spark.createDataFrame([(i, prompts[i], t) for i, t in rows], "doc_id INT, prompt STRING, text STRING")
    limits = Limits(tokens=600, segments=8, loss=250)
    check(rows, packed(table, WORDS, prompt_col="prompt", limits=limits).collect(), limits=limits, prompts=prompts)


def test_whole_examples_unless_none_holds_them(docs):
    rows = [(k, prose(k, 30 + 5 * k)) for k in range(60)]
    limits = Limits(tokens=1024)
    got = packed(docs(*rows).coalesce(1), WORDS, limits=limits, cut=False).collect()
    padding, tokens = check(rows, got, limits=limits)
    assert all(r.length == r.doc_tokens for r in got if r.doc_tokens <= 1024) and padding < 0.2 * tokens


def test_odd_tables(docs, none, spark):
    assert packed(none, WORDS).collect() == []
    got = packed(docs((1, None), (1, None), (None, "")), WORDS).collect()
    assert sorted((str(r.doc_id), r.start, r.length, r.ids) for r in got) == [("1", 0, 1, [2])] * 2 + [("None", 0, 1, [2])]
    names = spark.createDataFrame([("a", "x y"), ("b", None)], "doc_id STRING, text STRING")
    assert {r.doc_id for r in packed(names, BYTES).collect()} == {"a", "b"} and SCHEMA
    with pytest.raises(ValueError):
        packed(none, WORDS, limits=Limits(segments=0))
