import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seqframe.functions import tokens as T
from seqframe.model import LengthPolicy, Options, position_columns, target_columns
from seqframe.operators import placement as P


def rows(df):
    return df.collect()


def test_the_cipher(records):
    got = P.encode(records(("a", "ACGT"), ("b", ""), ("z", "Z"))).orderBy("ord").collect()
    assert [r.tokens for r in got] == [[1, 3, 7, 20], [], [26]]


def test_a_character_without_a_token_is_an_error(records):
    with pytest.raises(Exception, match="no token"):
        P.encode(records(("a", "AC-GT"))).collect()


def test_decode_drops_padding_and_refuses_foreign_tokens(spark):
    df = spark.createDataFrame([([1, 3, 0, 0],), ([],)], "tokens ARRAY<INT>")
    assert [r.decoded for r in P.decode(df).collect()] == ["AC", ""]
    for bad in ([27], [-1, 3]):
        with pytest.raises(Exception, match="outside 0..26"):
            P.decode(spark.createDataFrame([(bad,)], "tokens ARRAY<INT>")).collect()


def test_pad_and_truncate(records):
    got = {r.sample_id: r for r in P.place(records(("s", "ACGT"), ("l", "ACGTACGT"), ("e", "")), 6).collect()}
    assert got["s"].tokens == [1, 3, 7, 20, 0, 0]
    assert (got["s"].window_start, got["s"].window_end, got["s"].padding_cells) == (1, 4, 2)
    assert got["l"].tokens == [1, 3, 7, 20, 1, 3] and got["l"].residues_removed_by_truncation == 2
    assert got["e"].tokens == [0] * 6 and got["e"].window_end == 0


def test_width_stride_and_cap_are_checked(records):
    df = records(("a", "ACGT"))
    with pytest.raises(ValueError):
        P.place(df, 0)
    with pytest.raises(ValueError):
        P.place(df, 4, LengthPolicy.WINDOW, 0)
    with pytest.raises(ValueError, match="wider"):
        P.place(df, 4, LengthPolicy.WINDOW, 5)
    for bad in (0, -1):
        with pytest.raises(ValueError):
            Options(max_windows_per_sample=bad)
    for bad in (True, 2.0, "8"):
        with pytest.raises(TypeError):
            Options(max_windows_per_sample=bad)


def expected_windows(text: str, width: int, stride: int) -> list[tuple[int, str]]:
    out, offset = [], 0
    while True:
        out.append((offset + 1, text[offset : offset + width]))
        if offset + width >= len(text):
            return out
        offset += stride


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(width=st.integers(1, 9), data=st.data())
def test_windows_equal_brute_force(spark, width, data):
    stride = data.draw(st.integers(1, width))
    lengths = data.draw(st.lists(st.integers(0, 40), min_size=1, max_size=8))
    texts = ["".join(random.Random(n).choices("ACGT", k=n)) for n in lengths]
    df = spark.createDataFrame(list(enumerate(texts)), "k INT, sequence STRING").select(
        F.col("k").cast("string").alias("sample_id"), "sequence"
    )
    placed = P.place(df, width, LengthPolicy.WINDOW, stride, None)
    got = {}
    for r in placed.collect():
        got.setdefault(int(r.parent_sample_id), []).append((r.window_start, r.slice))
        assert T is not None and len(r.tokens) == width
        assert r.residues_in_row + r.padding_cells == width
    for i, text in enumerate(texts):
        assert sorted(got[i]) == expected_windows(text, width, stride)


def test_windows_are_named_and_end_with_the_sequence(records):
    got = P.place(records(("s1", "ACGT" * 10)), 8, LengthPolicy.WINDOW, 8, None).orderBy("window_index").collect()
    assert [r.sample_id for r in got] == [f"s1__w0{i}" for i in range(5)]
    assert [r.window_start for r in got] == [1, 9, 17, 25, 33]
    assert [r.window_end for r in got] == [8, 16, 24, 32, 40]
    single = P.place(records(("s1", "AC")), 8, LengthPolicy.WINDOW, 8, None).collect()
    assert [r.sample_id for r in single] == ["s1__w00"]


def test_the_cap_counts_windows_and_residues_on_the_last_kept_row(records):
    got = P.place(records(("s1", "ACGT" * 20)), 8, LengthPolicy.WINDOW, 8, 3).orderBy("window_index").collect()
    assert len(got) == 3
    assert [r.residues_dropped_by_window_cap for r in got] == [0, 0, 56]
    assert sum(r.windows_dropped for r in got) == 7


def test_ids_get_more_digits_after_the_cap_only(records):
    many = P.place(records(("s", "A" * 101)), 1, LengthPolicy.WINDOW, 1, None)
    assert {len(r.sample_id) for r in many.select("sample_id").collect()} == {len("s__w000")}
    capped = P.place(records(("s", "A" * 101)), 1, LengthPolicy.WINDOW, 1, 100)
    assert {len(r.sample_id) for r in capped.select("sample_id").collect()} == {len("s__w00")}


def test_column_names():
    assert position_columns(1000)[0] == "position_0001" and position_columns(12)[-1] == "position_12"
    assert position_columns(1000) == sorted(position_columns(1000))
    assert target_columns(1) == ["target"]
    assert target_columns(32)[2] == "target_02" and target_columns(32) == sorted(target_columns(32))
    with pytest.raises(ValueError):
        target_columns(0)


def test_widen_and_narrow_are_inverse_and_blank_is_not_zero(spark):
    df = spark.createDataFrame([("a", [1, 0], [3, 4, 0])], "sample_id STRING, target ARRAY<INT>, tokens ARRAY<INT>")
    wide = P.widen(df, 3, 2)
    assert wide.columns == ["sample_id", "target_0", "target_1", "position_1", "position_2", "position_3"]
    assert P.narrow(wide, 3, 2).first() == df.first()
    text = spark.createDataFrame([("a", "1", "", "2.0", "-3")], "sample_id STRING, target STRING, position_1 STRING, position_2 STRING, position_3 STRING")
    assert P.narrow(text, 3, 1).first().tokens == [None, None, -3]


def test_length_summary_is_the_upper_median(records):
    df = records(*[(str(i), "A" * n) for i, n in enumerate([5, 1, 9, 7])])
    assert P.length_summary(df).first() == (4, 1, 9, 7)
    assert P.length_summary(df.limit(0)).first() == (0, 0, 0, 0)


def test_blake2b_slices_match_the_standard_library(records):
    import hashlib

    row = P.place(records(("a", "ACGTT")), 4, digest="blake2b-256").first()
    assert row.slice_digest == hashlib.blake2b(b"ACGT", digest_size=32).hexdigest()


def test_stateless_operators_take_a_stream(spark, tmp_path, records):
    from seqframe.model import Alphabet
    from seqframe.operators.cleaning import clean_sequence

    records(("a", "ac gt"), ("b", "A1")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ord BIGINT, sample_id STRING, sequence STRING").parquet(str(tmp_path / "in"))
    cleaned = clean_sequence(stream, Alphabet.DNA_NUCLEOTIDE).filter("reason IS NULL").select("sample_id", "sequence")
    placed = P.place(cleaned, 3, LengthPolicy.WINDOW, 3, None)
    q = (
        placed.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    q.awaitTermination(60)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("window_index").collect()
    assert [r.slice for r in got] == ["ACG", "T"]
