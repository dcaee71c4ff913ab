"""What the plans must look like to hold at any size."""

from pyspark.sql import functions as F

from seqframe.model import Alphabet, LengthPolicy, Options
from seqframe.operators import linking as K
from seqframe.operators import placement as P
from seqframe.operators import quality as Q
from seqframe.operators.cleaning import clean_sequence
from seqframe.plans.convert import convert
from seqframe.plans.validate import table_facts
from tests.test_convert import ROWS, dataset


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_converting_moves_no_row_and_runs_no_python(spark):
    for opts in (Options(width=8), Options(width=8, policy=LengthPolicy.WINDOW, stride=4)):
        c = convert(dataset(spark, ROWS), opts)
        for df in (c.table, c.samples, c.quarantine):
            text = plan(df)
            assert "Exchange" not in text and "Python" not in text and "Arrow" not in text


def test_a_filter_on_the_quarantine_reason_does_not_repeat_the_cleaning(spark, records):
    cleaned = clean_sequence(records(("a", "AC")), Alphabet.DNA_NUCLEOTIDE).filter("reason IS NULL")
    text = plan(cleaned.select("sequence", "original_length"))
    assert text.count("RLIKE") == 1 and text.count("upper(") == 1


def test_a_table_digest_shuffles_one_row_of_sums(spark):
    df = spark.range(100).select(F.col("id").alias("ord"), F.col("id").cast("string").alias("sample_id"))
    text = plan(Q.ordered_digest(df, ["ord"], ["sample_id"]))
    assert text.count("Exchange") == 1 and "Sort " not in text and "partial_sum" in text


def test_all_table_facts_come_from_one_pass(spark):
    table = convert(dataset(spark, ROWS), Options(width=8)).table
    assert plan(table_facts(table)).count("Exchange") == 1


def test_listing_a_few_samples_of_a_hot_element_is_cut_before_the_shuffle(spark):
    links = spark.range(1000).select((F.col("id") % 2).cast("string").alias("element"), F.col("id").cast("string").alias("sample"))
    assert "WindowGroupLimit" in plan(K.samples_per_element(links))


def test_calls_are_resolved_without_collecting_them(spark):
    calls = spark.createDataFrame([("f", "a")], "file STRING, call STRING")
    text = plan(K.resolve_calls(calls, ["file"], "call"))
    assert "collect" not in text and "partial_min" in text


def test_no_operator_uses_a_cross_join(spark):
    pairs = spark.createDataFrame([("A", [0])], "sequence STRING, label ARRAY<INT>")
    for df in (Q.label_conflicts(pairs), K.length_baseline(spark.range(3).select(F.col("id").alias("len"), F.lit(1).alias("y")), "len", "y")):
        assert "Cartesian" not in plan(df) and "NestedLoop" not in plan(df)


def test_windows_cost_their_own_width(spark, records):
    """Windows of a long text are cut from bytes; the texts of all windows add up to one pass."""
    df = records(("long", "ACGT" * 500_000))
    placed = P.window(df, 1000, 1000)
    assert placed.agg(F.sum("residues_in_row")).first()[0] == 2_000_000
    assert "cast(_bytes" not in plan(placed).split("Generate")[-1]
