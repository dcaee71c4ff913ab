import hashlib
import re
from collections import Counter

from seqframe.llm.repeats import repeat_report, without_repeats
from tests.llm.conftest import ODD, prose


def brute(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def cases():
    passage, other = prose(1, 120), prose(2, 120)
    rows = [(k, prose(10 + k, 80) + passage[k : len(passage) - 2 * k] + prose(30 + k, 70)) for k in range(8)]
    rows += [(20, other), (21, other), (22, other[:-1] + "!"), (23, "!" + other[1:]), (24, passage + other + passage)]
    rows += [(30, "ab" * 600), (31, "x" * 399), (32, "x" * 401), (33, "é" * 250 + "q"), (34, "z" + "é" * 250), (35, "lorem ipsum " * 60)]
    rows += [(40, "line of text that is long enough to count\n" * 30 + prose(3, 20))]
    return rows


def test_equals_brute_force(docs):
    got = repeat_report(docs(*cases()))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared"]
    assert Counter(tuple(r)[:5] for r in got.collect()) == brute(cases(), 400)


def test_other_lengths_and_odd_rows(docs, odd):
    assert Counter(tuple(r)[:5] for r in repeat_report(docs(*cases()), length=256).collect()) == brute(cases(), 256)
    small = [r for r in ODD if r[0] != 10]
    assert Counter(tuple(r)[:5] for r in repeat_report(docs(*small)).collect()) == brute(small, 400)


def test_pieces_of_a_long_text(docs, monkeypatch):
    from seqframe.llm import repeats, words

    monkeypatch.setattr(repeats, "PIECE", 3_000)
    monkeypatch.setattr(words, "BLOCK", 2_000)
    rows = [(1, prose(5, 3_000, 5_000)), (2, prose(6, 500) + prose(5, 3_000, 5_000)[7_000:9_000] + prose(7, 500))]
    assert Counter(tuple(r)[:5] for r in repeat_report(docs(*rows)).collect()) == brute(rows, 400)


def test_texts_keep_whole_characters_and_columns(docs):
    cut = without_repeats(docs((1, "é" * 250 + "q"), (2, "z" + "é" * 250), (3, None), (4, "short")))
    got = {r.doc_id: r.text for r in cut.collect()}
    assert cut.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert got == {1: "q", 2: "z", 3: None, 4: "short"}


def test_empty_table(none):
    assert repeat_report(none).collect() == []
    assert without_repeats(none).collect() == []


def shared(rows, n=51):
    """Bytes of runs of n words that stand in another document: rows with another id or text."""
    found, out = {}, Counter()
    words = [[(m.start(), m.end(), m[0]) for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for _, t in rows]
    for row, w in zip(rows, words, strict=True):
        for k in range(len(w) - n + 1):
            found.setdefault(tuple(x for _, _, x in w[k : k + n]), set()).add(row)
    for (i, t), w in zip(rows, words, strict=True):
        gone = set()
        for k in range(len(w) - n + 1):
            if len(found[tuple(x for _, _, x in w[k : k + n])]) > 1:
                gone |= set(range(w[k][0], w[k + n - 1][1]))
        out[i, len(gone)] += 1
    return out


def test_passages_of_many_words_that_other_documents_have(docs):
    short = " ".join("a b c d e f g h i j".split()[(7 * k * k + k) % 10] for k in range(60))  # 60 words, 119 bytes
    passage = prose(1, 70)
    rows = [(1, prose(11, 40) + " " + short + " " + prose(12, 40)), (2, short), (3, short[: 2 * 50]), (4, prose(13, 30) + "\n" + passage), (5, passage + " " + prose(14, 90)), (6, passage + "  " + passage)]
    rows += [(7, prose(15, 80)), (8, prose(15, 80)), (9, "x " * 40 + prose(16, 60) + " " + prose(16, 60)), (10, prose(17, 50)), (11, prose(17, 50)), (12, None), (13, "")]
    rows += [(20 + k, prose(18, 300)[k:]) for k in range(6)]
    got = Counter((r.doc_id, r.n_shared) for r in repeat_report(docs(*rows)).collect())
    assert got == shared(rows)
    small = [*ODD[:9], *ODD[10:]]
    assert Counter((r.doc_id, r.n_shared) for r in repeat_report(docs(*small)).collect()) == shared(small)


def test_short_passages_are_cut_from_texts(docs):
    short = " ".join("a b c d e f g h i j".split()[(7 * k * k + k) % 10] for k in range(60))
    rows = [(1, prose(11, 40) + " " + short + " é " + prose(12, 40)), (2, "ü " + short), (3, prose(13, 40)), (4, None)]
    got = {r.doc_id: r.text for r in without_repeats(docs(*rows), words=51).collect()}
    assert got == {1: prose(11, 40) + "  é " + prose(12, 40), 2: "ü ", 3: rows[2][1], 4: None}
    assert without_repeats(docs(*rows)).filter("doc_id = 1").first().text == rows[0][1]


def test_cores_in_very_many_places_are_counted_by_their_windows(docs):
    """A bound of one, two and five places, as a passage in a third of all documents would pass the real one."""
    from seqframe.llm.repeats import _row, repeated_spans

    table = docs(*cases(), (50, "ab" * 600), (51, cases()[3][1]))
    named = table.withColumn("row", _row("doc_id", "text"))

    def covered(hot):
        out = {}
        for r in repeated_spans(named, hot=hot).collect():
            out[r.row] = {x for s in r.spans for x in range(s.begin, s.end)}
        return out

    plain = covered(1 << 16)
    assert plain and covered(1) == plain and covered(2) == plain and covered(5) == plain


def test_bytes_of_tuples_are_shuffled_once_by_core(spark):
    """The join with repeated cores, the grouping of equal tuples and the order of a core meet the rows where one shuffle left them."""
    from seqframe.llm.repeats import _compared

    rows = [(c, s, 0, 3, bytes([c, s]), b"r") for c in range(40) for s in range(3) for _ in range(2)]
    tuples = spark.createDataFrame(rows, "core long, same long, low short, high short, left binary, right binary")
    several = spark.createDataFrame([(c, 6) for c in range(30)], "core long, n long")
    for hint in ("merge", "broadcast"):
        got = _compared(tuples, several.hint(hint))
        moved = [line for line in got._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in line]
        assert len(moved) == (2 if hint == "merge" else 1) and not any("same" in line for line in moved)
        assert {(r.core, r.same, r.copies, bytes(r.left)) for r in got.collect()} == {(c, s, 2, bytes([c, s])) for c in range(30) for s in range(3)}
