import csv
import io
import random

import pytest
from pyspark.sql import types as T

from caseweave.sources import quoted, tables

COLUMNS = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b", "c")])


@pytest.fixture
def small_splits(spark):
    """Splits of a few dozen bytes, so that records and quoted fields lie across many of them."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "61")
    yield
    spark.conf.set(name, before)


def rows_of(spark, path):
    return sorted(tuple("" if v is None else v for v in r) for r in quoted.read_csv(spark, str(path), COLUMNS).collect())


def expected(text):
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    return sorted(tuple(r) for r in rows[1:])


@pytest.mark.parametrize("seed", range(4))
def test_like_a_sequential_reader(spark, tmp_path, small_splits, seed):
    chance = random.Random(seed)
    folder = tmp_path / "csv"
    folder.mkdir()
    wanted = []
    for number in range(3):
        out = io.StringIO(newline="")
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(["a", "b\nin two lines", "c"])
        for i in range(60):
            parts = ['"', "\n", ",", "x", "word ", '""', "\n\n", "ß", '","']
            long = chance.random() < 0.1
            writer.writerow([str(i)] + ["".join(chance.choices(parts, k=chance.randrange(120 if long else 6))) for _ in range(2)])
            if chance.random() < 0.2:
                out.write("\n")
        text = out.getvalue()
        (folder / f"{number}.csv").write_bytes(text.encode())
        wanted += expected(text)
    assert rows_of(spark, folder) == sorted(wanted)


def test_quotes_inside_unquoted_fields_open_nothing(spark, tmp_path, small_splits):
    text = 'a,b,c\n' + "".join(f'{i},say "hi,5" wide\n{i},"two\nlines",x"\n' for i in range(30))
    (tmp_path / "stray.csv").write_text(text)
    assert rows_of(spark, tmp_path / "stray.csv") == expected(text)


def test_carriage_returns_and_blank_lines(spark, tmp_path, small_splits):
    (tmp_path / "dos.csv").write_bytes(b'\r\na,b,c\r\n1,"x\r\n\r\ny",z\r\n\r\n2,,\r\n3,"",last')
    assert rows_of(spark, tmp_path / "dos.csv") == [("1", "x\r\n\r\ny", "z"), ("2", "", ""), ("3", "", "last")]


def test_a_field_over_hundreds_of_splits(spark, tmp_path, small_splits):
    text = "a,b,c\n1,2,3\n" + '4,"' + "line of text\n" * 2_000 + '",5\n6,7,8\n'
    (tmp_path / "long.csv").write_text(text)
    assert rows_of(spark, tmp_path / "long.csv") == expected(text)


def test_a_long_line_without_recursion(spark, tmp_path):
    text = "a,b,c\n" + '1,"' + 'q""' * 300_000 + '",' + "," * 0 + "z\n"
    (tmp_path / "wide.csv").write_text(text)
    assert [len(v) for v in rows_of(spark, tmp_path / "wide.csv")[0]] == [1, 600_000, 1]


def test_unclosed_and_empty_files(spark, tmp_path, small_splits):
    (tmp_path / "cut.csv").write_text('a,b,c\n1,"never closed\n2,3,4\n' + "x\n" * 100)
    with pytest.raises(ValueError, match="cut.csv ends inside"):
        quoted.read_csv(spark, str(tmp_path / "cut.csv"), COLUMNS)
    (tmp_path / "none.csv").write_text("")
    assert rows_of(spark, tmp_path / "none.csv") == []
    (tmp_path / "header.csv").write_text("a,b,c\n")
    assert rows_of(spark, tmp_path / "header.csv") == []


def test_several_tasks_read_one_file(spark, tmp_path, small_splits):
    (tmp_path / "m.csv").write_text("a,b,c\n" + '1,"x\ny",z\n' * 200)
    table = tables.read_table(spark, str(tmp_path / "m.csv"), COLUMNS)
    assert table.count() == 200
    assert quoted._lines(spark, str(tmp_path / "m.csv")).rdd.getNumPartitions() > 8
