"""A file of many licences has all their labels."""

from seqframe.llm.license_scan import TEMPLATES, scan_licenses
from tests.llm.conftest import prose


def test_every_notice_of_a_file_is_labelled(docs):
    every = [text for _, text, _ in TEMPLATES]
    rows = [(1, ". ".join(every)), (2, f" {prose(5)} ".join(reversed(every)))]
    often = [(10 + k, text) for k, (label, text, _) in enumerate(TEMPLATES * 9) if label in ("agpl", "gpl-3.0", "mit")]
    want = ",".join(sorted({label for label, _, _ in TEMPLATES} | {"gpl", "cc-by"}))  # these two are base phrases
    got = {r.doc_id: r for r in scan_licenses(docs(*rows, *often)).collect()}
    assert got[1].labels == got[2].labels == want


def test_rare_words_elsewhere_do_not_hide_a_place(docs):
    words = [f"t{k:02}" for k in range(60)]
    table = [("long", " ".join(words), [" ".join(words[:5])])]
    rest = ["x"] * 24  # 36 of 60 agree, and the other 24 stand at the end in another order
    text = " ".join([*words[:36], *rest, "y", *reversed(words[36:])])
    others = [(k, " ".join(words[:36])) for k in range(2, 9)]  # which makes those 24 the rarest
    got = {r.doc_id: r.labels for r in scan_licenses(docs((1, text), *others), templates=table).collect()}
    assert got[1] == "long"
