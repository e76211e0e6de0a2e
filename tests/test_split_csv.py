"""Multi-line CSV by splits: equal to the multi-line reader, wherever the splits fall."""

import csv
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferry.sources.csv import QUOTED_DIALECT, read_csv
from ferry.sources.split_csv import cut_records, read_csv_splits

VALUE = st.text(alphabet='ab",\n\ré;', max_size=9)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def write(path, rows, header=("Id", "A", "B"), terminator="\n", last=True):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator=terminator, quoting=csv.QUOTE_MINIMAL)
        w.writerow(header)
        w.writerows(rows)
    if not last:
        text = open(path, newline="").read()
        open(path, "w", newline="").write(text[:-len(terminator)])


@pytest.fixture(scope="module")
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield spark
    for k, v in kept.items():
        spark.conf.set(k, v)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(VALUE, VALUE, VALUE), min_size=1, max_size=8), st.sampled_from(["\n", "\r\n"]), st.booleans())
def test_equals_the_multi_line_reader(small_splits, rows, terminator, last):
    folder = tempfile.mkdtemp(prefix="ferry-split-")
    # A lone value that is empty would be a blank line; a carriage return outside quotes is the reader's own matter.
    rows = [(f"k{i}", a, b + c) for i, (a, b, c) in enumerate(rows)]
    write(f"{folder}/a.csv", rows, terminator=terminator, last=last)
    write(f"{folder}/b.csv", rows[::-1], ("Id", "A", "B"), terminator)
    want = read_csv(small_splits, folder)
    got = read_csv(small_splits, folder, multiline="split")
    assert got.columns == want.columns
    assert rows_of(got) == rows_of(want)


def test_chunks_smaller_than_records_and_headers(small_splits, tmp_dir):
    rows = [("1", "x\n" * 60, ""), ("2", 'say "hi"\n\n', "y"), ("3", "", "\n\n\nz")]
    write(f"{tmp_dir}/a.csv", rows, ("Id", "two\nline header", "B"))
    schema = read_csv(small_splits, tmp_dir).schema
    for chunk in (1, 1 << 20):
        got = read_csv_splits(small_splits, tmp_dir, schema, QUOTED_DIALECT, chunk_bytes=chunk)
        assert rows_of(got) == rows_of(read_csv(small_splits, tmp_dir))


def test_one_file_is_read_by_many_tasks(small_splits, tmp_dir):
    write(f"{tmp_dir}/a.csv", [(i, f"line\nbreak {i}", "z") for i in range(120)])
    got = read_csv(small_splits, f"{tmp_dir}/a.csv", multiline="split")
    assert got.count() == 120 and rows_of(got) == rows_of(read_csv(small_splits, f"{tmp_dir}/a.csv"))
    lines = small_splits.read.option("lineSep", "\n").text(f"{tmp_dir}/a.csv")
    assert lines.rdd.getNumPartitions() > 15
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_stray_quotes_are_refused(spark, tmp_dir):
    open(f"{tmp_dir}/a.csv", "w").write('Id,A\n1,5" pipe\n2,x\n3,6" pipe\n')
    with pytest.raises(Exception, match="quote inside an unquoted value"):
        read_csv(spark, tmp_dir, multiline="split").collect()


def test_blank_lines_and_short_rows(spark, tmp_dir):
    open(f"{tmp_dir}/a.csv", "w").write('\nId,A,B\n\n1,x\n\n2,"y\n\ny",z,extra\n3,,"" \n\n')
    assert rows_of(read_csv(spark, tmp_dir, multiline="split")) == rows_of(read_csv(spark, tmp_dir))


def test_cut_records():
    text = 'a,"b\nc"\nd\n'
    assert cut_records(text, False, ",") == ([8, 10], False)
    assert cut_records('c"\nd\n', True, ",")[0] == [3, 5]
    assert cut_records('x"\n', False, ",")[1]
