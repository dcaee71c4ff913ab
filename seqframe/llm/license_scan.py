"""License scans with a positional index of rare words.

Templates are runs of words that licences are known by. The index has, for each word of a template, where
it stands in which templates. Of a file, only its rarest licence words are looked up (rare by the inverse
document frequency over the whole corpus); each occurrence votes for the template and the place where that
template would begin. Where votes meet, the words around are aligned with the template, and a label is
given if the template's mandatory phrases stand in that place and enough of its words agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.llm.words import ALNUM, Hasher, U, blocks, words

#: Base phrases and their labels, as fixed by the contract.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices of public licences, with the phrases that must stand in them.
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ["permission is hereby granted free of charge"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["redistribution and use in source and binary forms"]),
    ("bsd", "licensed under the bsd license", ["bsd license"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["lesser general public license"]),
    ("agpl", "licensed under the gnu affero general public license", ["affero general public license"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license v 2 0"]),
    ("epl-2.0", "made available under the terms of the eclipse public license 2 0", ["eclipse public license 2 0"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", ["permission to use copy modify and or distribute"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    ("cc0", "creative commons cc0 1 0 universal", ["cc0 1 0 universal"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-nd", "licensed under cc by nd 4 0", ["cc by nd"]),
]
#: Different words of each template that are looked up in a file, the rarest, or more if that many may disagree; and the share of a
#: template's words that must agree.
RAREST, AGREE = 24, 0.6


def _hash_words(phrase: str) -> np.ndarray:
    parts = phrase.encode().split()
    data = np.frombuffer(b" ".join(parts), np.uint8)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = ends - np.array([len(p) for p in parts])
    return Hasher(lower=True).ranges(data, starts, ends)


def _places(hashes: np.ndarray, rows: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Numbers of the words at which the phrase begins, inside one row."""
    n = len(phrase)
    if len(hashes) < n:
        return np.zeros(0, np.int64)
    hit = np.ones(len(hashes) - n + 1, bool)
    for k in range(n):
        hit &= hashes[k : len(hit) + k] == phrase[k]
    at = np.flatnonzero(hit)
    return at[np.searchsorted(rows, at, "right") == np.searchsorted(rows, at + n - 1, "right")]


class Index:
    """Postings of the templates' words: for each word hash (template, place)."""

    def __init__(self, templates):
        self.labels = [label for label, _, _ in templates]
        self.texts = [_hash_words(text) for _, text, _ in templates]
        self.keys = [[_hash_words(k) for k in keys] for _, _, keys in templates]
        self.vocabulary = np.unique(np.concatenate([*self.texts, np.zeros(0, U)]))
        self.postings: dict[int, list[tuple[int, int]]] = {}
        for t, text in enumerate(self.texts):
            for place, h in enumerate(text):
                self.postings.setdefault(int(h), []).append((t, place))

    def known(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return self.vocabulary[at] == hashes if len(self.vocabulary) else np.zeros(len(hashes), bool)


def _frequencies(templates):
    """In how many documents of a part of the scan each licence word stands."""

    def run(batches):
        index, hasher = Index(templates), Hasher(lower=True)
        counts = np.zeros(len(index.vocabulary), np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                w = words(block, ALNUM)
                hashes = hasher.ranges(block.data, w.starts, w.ends)
                known = np.flatnonzero(index.known(hashes))
                pair = np.unique(w.row_of()[known] * len(counts) + np.searchsorted(index.vocabulary, hashes[known]))
                counts += np.bincount(pair % max(len(counts), 1), minlength=len(counts))
        yield pa.record_batch({"word": index.vocabulary.view(np.int64), "docs": counts})

    return run


def _labelled(hashes: np.ndarray, known: np.ndarray, index: Index, idf: dict[int, float], rarest: int, agree: float) -> tuple[set[str], float]:
    """Labels of one document by the index, and the best agreement with a template."""
    mine = hashes[known]
    order = np.argsort(mine, kind="stable")
    different, first = np.unique(mine[order], return_index=True)
    where = dict(zip(different.tolist(), np.split(known[order], first[1:]), strict=True))
    by_template: dict[int, list[int]] = {}
    for h in sorted(where, key=lambda h: (-idf.get(h, 0.0), h)):
        for t in {t for t, _ in index.postings[h]}:
            by_template.setdefault(t, []).append(h)
    votes: dict[tuple[int, int], float] = {}
    for t, held in by_template.items():
        for h in held[: max(rarest, int((1 - agree) * len(index.texts[t]) + 1e-9) + 1)]:  # so one at least stands in a place that agrees
            for place in (place for of, place in index.postings[h] if of == t):
                for at in where[h].tolist():
                    votes[t, at - place] = votes.get((t, at - place), 0.0) + idf.get(h, 0.0)
    labels, best = set(), 0.0
    for (t, begin), _ in votes.items():
        text = index.texts[t]
        low, high = max(begin, 0), min(begin + len(text), len(hashes))
        share = float((hashes[low:high] == text[low - begin : high - begin]).sum()) / len(text)
        best = max(best, share)
        if share >= agree and all(len(_places(hashes[low:high], np.array([0, high - low]), key)) for key in index.keys[t]):
            labels.add(index.labels[t])
    return labels, best


def _scanned(templates, phrases, idf, rarest: int, agree: float):
    def run(batches):
        index, hasher, rarity = Index(templates), Hasher(lower=True), idf.value
        base = [(label, _hash_words(phrase)) for phrase, label in phrases.items()]
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for block in blocks(batch.column(1)):
                w = words(block, ALNUM)
                hashes = hasher.ranges(block.data, w.starts, w.ends)
                found: list[tuple[str, int, int]] = []
                for label, phrase in base:
                    at = _places(hashes, w.rows, phrase)
                    found += [(label, r, a) for r, a in zip((np.searchsorted(w.rows, at, "right") - 1).tolist(), at.tolist(), strict=True)]
                by_row: dict[int, list] = {}
                for label, r, a in found:
                    by_row.setdefault(r, []).append((label, a - int(w.rows[r])))
                known = np.flatnonzero(index.known(hashes))
                edges = np.searchsorted(known, w.rows)
                for r in range(block.rows):
                    own, labels, score = by_row.get(r, []), set(), 0.0
                    if edges[r + 1] > edges[r]:
                        labels, score = _labelled(hashes[w.rows[r] : w.rows[r + 1]], known[edges[r] : edges[r + 1]] - w.rows[r], index, rarity, rarest, agree)
                    names, at = {label for label, _ in own}, [a for _, a in own]
                    row = (int(w.rows[r + 1] - w.rows[r]), len(own), min(at, default=None), max(at, default=None), ",".join(sorted(names)), ",".join(sorted(names | labels)), 1.0 if names else score)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.record_batch([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return run


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES, rarest: int = RAREST, agree: float = AGREE) -> DataFrame:
    """One row per input row: ``id_col``, n_words, n_base, first_word, last_word, base_labels, labels, score (action).

    Words are runs of ASCII letters (A-Z lower-cased), digits and non-ASCII characters. base_labels come from all
    places where a phrase stands; labels add those of the index. score is 1 with a base label, else the largest
    share of a template's words that stands in one place. Null, empty and wordless texts have counts of 0, empty
    labels and null places. Ties in rarity are broken by the word's hash. Equal rows get equal results.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = rows.select("text").mapInArrow(_frequencies(templates), "word long, docs long").groupBy("word").agg(F.sum("docs").alias("docs")).collect()  # one row per template word
    idf = {int(np.int64(r.word).view(U)): float(1 / np.log(2.0 + r.docs)) for r in counts}
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    out = rows.mapInArrow(_scanned(templates, phrases, shared, rarest, agree), f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
    return out.withColumnRenamed("id", id_col)
