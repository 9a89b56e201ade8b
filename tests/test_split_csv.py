"""The splitting reader equals the multiLine reader, wherever the splits fall."""

import csv
import random

import pytest

from starmart.schemas import DATE, DOUBLE, INT, STRING, struct
from starmart.sources.delimited import read_csv_typed, write_csv

SCHEMA = struct(k=INT, t=STRING, x=DOUBLE, u=STRING, d=DATE)


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def split_bytes(spark):
    """Set the size at which text files are split."""

    def set_size(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_size
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _text(rng):
    parts = ['"', "\n", ",", "a", "word ", "ä", "\n\n", '""', '","', "\\", "\r\n", "'"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(12)))


def _file(path, rng, rows, newline):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=newline)
        out.writerow(["key", "a, text" if newline == "\r\n" else "some\ntext", "x", "u", "d"])
        for i in range(rows):
            number = rng.choice(["1.5", "", "bad"])
            day = rng.choice(["1995-10-30", "", "1995-99-99"])
            out.writerow([i, "t" + _text(rng) + "t", number, "u" + _text(rng) + "u", day])


@pytest.mark.parametrize("size", [45, 333])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_equals_multiline_reader(spark, tmp_path, split_bytes, size, newline):
    rng = random.Random(size)
    folder = tmp_path / "in"
    folder.mkdir()
    for i, rows in enumerate([40, 1, 0, 12]):
        _file(folder / f"{i}.csv", rng, rows, newline)
    expected = bag(read_csv_typed(spark, str(folder), SCHEMA))
    assert len(expected) == 53
    split_bytes(size)
    out = read_csv_typed(spark, str(folder), SCHEMA, "rfc4180_split")
    assert out.schema == SCHEMA
    assert bag(out) == expected


def test_one_record_over_many_splits(spark, tmp_path, split_bytes):
    long = "\n".join(f"line {i}, with a comma" for i in range(200))
    df = spark.createDataFrame([(1, long), (2, "short"), (3, "\n")], "k int, t string").coalesce(1)
    write_csv(df, str(tmp_path / "c"))
    split_bytes(64)
    out = read_csv_typed(spark, str(tmp_path / "c"), df.schema, "rfc4180_split")
    assert bag(out) == bag(df)


def test_quote_without_end(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,t\n1,"open\n2,x\n')
    with pytest.raises(ValueError, match="a.csv"):
        read_csv_typed(spark, str(tmp_path), SCHEMA, "rfc4180_split")


@pytest.mark.parametrize(
    "line",
    ['1,5" screen', '1,say "x" y', '1,"a" b', '1,"a\\"b"', "   ", '1,x"'],
)
def test_what_is_not_strict_is_an_error(spark, tmp_path, line):
    (tmp_path / "a.csv").write_text(f'k,t\n0,before\n{line}\n2,"after"\n3,4" more\n')
    with pytest.raises(Exception, match="a.csv"):
        read_csv_typed(spark, str(tmp_path), SCHEMA, "rfc4180_split").collect()


def test_stray_marks_keep_their_rows_at_every_size(spark, tmp_path, split_bytes):
    rows = ['1,5" screen,a', "2,b,b", "3,c,c", "4,d,d", '5,4 7" disk,f']
    (tmp_path / "a.csv").write_text("k,t,u\n" + "\n".join(rows) + "\n")
    split_bytes(8)
    schema = struct(k=INT, t=STRING, u=STRING)
    assert [r.k for r in read_csv_typed(spark, str(tmp_path), schema).collect()] == [1, 2, 3, 4, 5]


def test_empty_lines_are_no_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,t\n\n1,"x"\n\n\n2,y\n\n')
    for dialect in ("rfc4180", "rfc4180_split"):
        assert [r.k for r in read_csv_typed(spark, str(tmp_path), struct(k=INT, t=STRING), dialect).collect()] == [1, 2]
