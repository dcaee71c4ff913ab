"""Blocks of CSV files by byte ranges against the csv module."""

import csv
import random

import pytest

from seqframe.sources import blocks as B


def write(path, rows, names=("k", "note", "v")):
    with open(path, "w", newline="") as file:
        out = csv.writer(file, lineterminator="\n")
        out.writerow(names)
        out.writerows(rows)


@pytest.fixture
def rows():
    rng = random.Random(3)
    notes = ["plain", "with, comma", 'a "quoted" word', "two\nlines", 'x"\n"y', "", "é" * 9, "a\n\nb,c"]
    return [[str(k), rng.choice(notes) * rng.randrange(1, 4), str(rng.random())] for k in range(4000)]


def test_blocks_hold_whole_records_from_their_places(spark, tmp_path, rows):
    path = str(tmp_path / "t.csv")
    write(path, rows)
    got = B.read_strided_blocks(spark, path, blocks=5, block_bytes=4000).collect()
    known = {tuple(r): i for i, r in enumerate(rows)}
    assert {r.block for r in got} == {1, 2, 3, 4, 5}
    for b in range(1, 6):
        at = sorted(known[r.k, r.note, r.v] for r in got if r.block == b)
        assert at == list(range(at[0], at[0] + len(at))) and len(at) > 30
    assert [f.name for f in B.read_strided_blocks(spark, path).schema][:3] == ["block", "block_start", "k"]


def test_what_is_read_does_not_grow_with_the_file(spark, tmp_path, rows, monkeypatch):
    sizes = []
    for times in (1, 10):
        path = str(tmp_path / f"t{times}.csv")
        write(path, rows * times)
        read, whole = [], B.Files.read
        monkeypatch.setattr(B.Files, "read", lambda self, a, b: read.append(b - a) or whole(self, a, b))  # noqa: B023
        reader = B.StridedReader({"path": path, "blocks": "4", "block_bytes": "8000"}, ["k", "note", "v"])
        found = [r for p in reader.partitions() for r in reader.read(p)]
        monkeypatch.undo()
        sizes.append((sum(read), len(found)))
    assert sizes[0][0] == sizes[1][0] and abs(sizes[0][1] - sizes[1][1]) < 0.2 * sizes[0][1]


@pytest.mark.parametrize("start", range(0, 60, 7))
def test_a_range_may_begin_inside_a_quoted_cell(start):
    raw = b'1,"a\nb",x\n2,"c,\n\nd",y\n3,plain,z\n4,"e\n""f""\n",w\n5,"g\nh",v\n6,i,u\n'
    want = [r for r in csv.reader(raw.decode().splitlines(keepends=True))]
    readings = [[B.cells(raw[start:][a:b]) for a, b in B.records(raw[start:], q)] for q in (False, True)]
    best = max(readings, key=lambda rows: sum(1 if len(r) == 3 else -1 for r in rows))
    assert all(r in want for r in best)


def test_several_files_without_headers(spark, tmp_path):
    for part in range(3):
        (tmp_path / f"part-{part}.csv").write_text("".join(f"{100 * part + k:05d},x\n" for k in range(100)))
    (tmp_path / "_SUCCESS").write_text("")
    got = B.read_strided_blocks(spark, str(tmp_path), blocks=2, block_bytes=80, columns=["n", "c"]).collect()
    # 300 records of 8 bytes; blocks begin at bytes 800 and 1600.
    assert sorted((r.block, r.block_start, int(r.n)) for r in got) == [(b, 800 * b, 100 * b + k) for b in (1, 2) for k in range(10)]
