"""License scans, token counts, quality rules and language-model scores against plain Python."""

import math
import re
import zlib
from collections import Counter

import pytest

from seqframe.llm.license_scan import scan_licenses
from seqframe.llm.lm_scoring import LogFrequencyFilter, score_documents, scored_corpus
from seqframe.llm.quality_rules import quality_rules
from seqframe.llm.token_counts import default_tokenizer, token_counts
from tests.llm.conftest import ODD, lowered, prose, spaced

PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
NOTICES = [
    (50, "x. Released under the MIT License. y"),
    (51, "This work is licensed under the GNU General Public License, version 3. All rights reserved."),
    (52, "Licensed under CC BY-NC 4.0. CC BY"),
    (53, "licensed under the apache Licence version 2.0"),
    (54, "Licensed under the Apache License, Version 2.0."),
    (55, "general public\nlicense"),
    (56, "general public"),
    (57, "license " * 40),
]


def test_license_base_columns(docs):
    rows = ODD + NOTICES
    got = Counter(tuple(r)[:6] for r in scan_licenses(docs(*rows)).collect())
    want = Counter()
    for i, text in rows:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(text))
        hits = [(k, name) for p, name in PHRASES.items() for k in range(len(w)) if tuple(w[k : k + len(p)]) == p]
        at = [k for k, _ in hits]
        want[i, len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({n for _, n in hits}))] += 1
    assert got == want


def test_license_labels(docs):
    got = {r.doc_id: (r.labels, r.score) for r in scan_licenses(docs(*NOTICES)).collect()}
    assert [got[k][0] for k in (50, 51, 52, 53, 54, 56)] == ["mit", "gpl,gpl-3.0,reserved", "cc-by,cc-by-nc", "", "apache-2.0", ""]
    assert all(0 <= s <= 1 for _, s in got.values())


def test_token_counts_equal_the_library(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(default_tokenizer())
    rows = [*ODD, (60, "a<|endoftext|>b <|endoftext|>"), (61, "it's we'LL 12 3.4  \n\n x \t"), (62, "日本語 текст 🙂🙂"), (63, "word" * 500)]
    got = Counter(map(tuple, token_counts(docs(*rows), limit=50).collect()))
    sizes = [len(library.encode(t or "", add_special_tokens=False)) for _, t in rows]
    assert got == Counter((i, len((t or "").encode()), n, n > 50) for (i, t), n in zip(rows, sizes, strict=True))


def base(text):
    w, lines, seen, dup = re.findall("[^\x20\x09-\x0d]+", text or ""), (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = {k + j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_quality_base_rules(docs, spark):
    rows = [*ODD, (70, "a b c d e f\na b c d e f\n\n \na b c d e f"), (71, "été # *$ %&|<> x\r\nx\r\n"), (72, " a\na\n a")]
    labels = spark.createDataFrame([(8, 1, 0), (12, 0, 0), (None, 1, 0), (4, 7, 0)], "doc_id BIGINT, quality INT, toxic INT")
    got = quality_rules(docs(*rows), labels).collect()
    assert Counter(tuple(r)[:6] for r in got) == Counter((i, *base(t)) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert 0 <= r.score <= 1 and not (r.kept and r.base_failed)


def test_quality_learns_the_labels(docs, spark):
    good = [(k, prose(k, 60)) for k in range(60)]
    junk = [(100 + k, " ".join(f"{w}$$$" for w in prose(k + 500, 60).split())) for k in range(60)]
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i, _ in good[:45] + junk[:45]], "doc_id BIGINT, quality INT, toxic INT")
    kept = {r.doc_id: r.kept for r in quality_rules(docs(*good, *junk), labels).collect()}
    assert sum(kept[i] for i, _ in good[45:]) >= 14 and not any(kept[i] for i, _ in junk[45:])


def test_quality_learns_one_text_of_an_id(docs, spark):
    """Copies of a labelled id bring no more to the driver than one, and equal texts score alike wherever they lie."""
    rows = [(1, prose(k, 30)) for k in range(300)] + [(2, "a$ b$ c$ " * 20)] * 200 + [(5, prose(3, 40))] * 7
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id BIGINT, quality INT, toxic INT")
    got = {}
    for df in (docs(*rows), docs(*rows[::-1]).repartition(3)):
        scored = quality_rules(df, labels).collect()
        got[len(got)] = {(r.doc_id, r.n_words, r.score) for r in scored if r.doc_id in (2, 5)}
    assert got[0] == got[1] and len(got[0]) == 2


def test_quality_without_labels(docs, spark):
    labels = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    assert {r.score for r in quality_rules(docs((1, prose(1)), (2, None)), labels).collect()} == {0.5}


def test_lm_base_scores(docs):
    rows = [*ODD, *((200 + k, prose(k, 50)) for k in range(30))]
    got = scored_corpus(docs(*rows)).collect()
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = [(i, [*spaced(t), None]) for i, t in rows]
    counts = Counter(x for i, w in tokens if not out(i) for x in w)
    total, scale = sum(counts.values()), math.log10(sum(counts.values()) + 0.5 * (len(counts) + 1))
    want = Counter((i, out(i), len(w), sum(counts[x] > 0 for x in w), total, round(sum(math.log10(counts[x] + 0.5) - scale for x in w), 6)) for i, w in tokens)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_lm_prefers_what_it_has_seen(docs):
    train = docs(*((k, prose(k % 3, 80)) for k in range(12)))
    got = {r.doc_id: r.score / r.n_tokens for r in score_documents(docs((1, prose(0, 80)), (2, " ".join(reversed(prose(0, 80).split()))), (3, prose(77, 80, 10**6))), train).collect()}
    assert got[1] > got[2] > got[3]


def test_lm_scores_do_not_depend_on_what_is_sent_at_a_time(docs, monkeypatch):
    from seqframe.llm import lm_scoring

    rows = [*ODD, *((200 + k, prose(k % 20, 60)) for k in range(40))]
    scores = lambda: Counter((r.doc_id, r.n_tokens, round(r.score, 9)) for r in scored_corpus(docs(*rows)).collect())
    whole = scores()
    monkeypatch.setattr(lm_scoring, "SENT_BYTES", 4_096)
    assert scores() == whole


def test_lm_learns_bigrams_that_occur_once(docs):
    """A text seen once is likelier than its words in another order."""
    train = docs(*((k, prose(900 + k, 80, 400)) for k in range(6)))
    text = prose(903, 80, 400).split()
    got = {r.doc_id: r.score for r in score_documents(docs((1, " ".join(text)), (2, " ".join(sorted(text)))), train).collect()}
    assert got[1] > got[2]


def test_lm_without_training_rows(docs, none):
    rows = score_documents(docs((1, "a b"), (2, None)), none).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in rows) == [(1, 3, 0, 0), (2, 1, 0, 0)]


@pytest.mark.parametrize("scan", [scan_licenses, token_counts, scored_corpus])
def test_empty_tables(none, scan):
    assert scan(none).collect() == []


def test_filter_holds_every_count():
    import numpy as np

    from seqframe.llm.lm_scoring import _segments, level_of

    import pyarrow as pa

    rng = np.random.RandomState(1)
    hashes, counts = np.unique(rng.randint(0, 2**62, 3_000).astype(np.uint64)), None
    counts = rng.randint(1, 500, len(hashes)).astype(np.int64)
    batch = pa.record_batch([pa.array([0], pa.int32()), pa.array([1], pa.int32()), pa.array([hashes.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary())], ["bucket", "order", "hashes", "counts"])
    words = np.frombuffer(next(_segments(4_000)([batch])).column(1)[0].as_py(), np.uint64)
    levels = LogFrequencyFilter(words, 1).levels(hashes)
    assert (levels >= level_of(counts)).all() and (levels == level_of(counts)).mean() > 0.9
