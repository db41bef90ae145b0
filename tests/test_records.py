"""CSV files cut at any place give the records that one task reads."""

import csv
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from driftline.sources import records, tables

NAMES = ["text", "date", "views", "extra"]
CELLS = ["", "plain", "a,b", 'say "so"', "two\nlines", "\n\n", '"', '""', 'x"\n"y', "é 漢\n😀", " padded ", "line\r\nend", "," * 5, "word " * 60 + "\n" + "more " * 60]


@pytest.fixture
def cut(spark):
    """Splits of so many bytes, however small the files."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def at(size):
        for name in names:
            spark.conf.set(name, str(size))

    yield at
    for name, value in before.items():
        spark.conf.set(name, value)


def written(path, n, seed, ending="\n", quoting=csv.QUOTE_ALL, bom=""):
    rng = random.Random(seed)
    with open(path, "w", newline="", encoding="utf-8") as out:
        out.write(bom)
        table = csv.writer(out, lineterminator=ending, quoting=quoting)
        table.writerow(NAMES)
        made = [[rng.choice(CELLS), f"2024-01-{rng.randint(1, 28):02}", str(rng.randint(0, 99)), rng.choice(CELLS)] for _ in range(n)]
        table.writerows(made)
    return made


def plain(spark, path):
    return spark.read.options(**tables.CSV_OPTIONS, inferSchema=False).schema("text string, date string, views string, extra string").csv(path)


@pytest.mark.parametrize("size", [40, 700, 10**7])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("quoting", [csv.QUOTE_ALL, csv.QUOTE_MINIMAL])
def test_records_are_those_of_one_task(spark, tmp_path, cut, size, ending, quoting):
    path = str(tmp_path / "a b.csv")
    made = written(path, 20, size, ending, quoting)
    expected = sorted((tuple(cell or None for cell in row) for row in made), key=str)
    # In a file of other line ends one task changes those within cells as well.
    assert ending == "\r\n" or rows(plain(spark, path)) == expected
    cut(size)
    read = tables.read_checked_csv(spark, path, plain(spark, path).schema, ["text"])
    assert records.lines(spark, path).rdd.getNumPartitions() > (1 if size < 1000 else 0)
    assert rows(read.drop("source_file")) == expected


def test_files_of_several_headers_cut(spark, tmp_path, cut):
    first, second = written(tmp_path / "1.csv", 40, 1, bom="﻿"), written(tmp_path / "2.csv", 30, 2)
    with open(tmp_path / "3.csv", "w", newline="") as out:
        csv.writer(out).writerows([["date", "other", "text"], ["2024-02-01", "x\ny", "last\nfile"], ["2024-02-02", "", "no break"]])
    (tmp_path / "4.csv").write_text("text,date\n")
    (tmp_path / "5.csv").write_text("")
    cut(50)
    read = tables.read_checked_csv(spark, str(tmp_path), plain(spark, str(tmp_path / "1.csv")).schema, ["text", "date"])
    counted = dict(read.groupBy(F.regexp_extract("source_file", r"(\d)\.csv", 1).alias("f")).count().collect())
    assert counted == {"1": len(first), "2": len(second), "3": 2}
    assert rows(read.filter("source_file LIKE '%3.csv'").select("text", "views", "extra")) == [("last\nfile", None, None), ("no break", None, None)]


def test_a_cell_over_many_splits(spark, tmp_path, cut):
    path = str(tmp_path / "long.csv")
    long = "\n".join(f"line {i}" for i in range(500))
    with open(path, "w", newline="") as out:
        csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows([NAMES, ["before", "d", "1", ""], [long, "d", "2", "x"], ["after", "d", "3", ""]])
    cut(64)
    read = tables.read_checked_csv(spark, path, plain(spark, path).schema, NAMES)
    assert rows(read, "text", "views") == sorted([("before", "1"), (long, "2"), ("after", "3")], key=str)


def test_each_split_is_read_by_a_task_of_its_own(spark, tmp_path, cut):
    path = str(tmp_path / "many.csv")
    written(path, 3000, 3)
    cut(20_000)
    known = records.splits(spark, path)
    assert known.count() > 10 and 0 < known.filter("inside").count() < known.count()
    found = records.records(spark, path, known)
    assert found.count() == 3000
    sizes = [r.n for r in found.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) > 10 and max(sizes) < 3 * 3000 / len(sizes)
