"""Files with quoted line breaks, cut into splits of a few bytes, against Spark's own reader."""

import random

import pytest

from groundplan.sources import csv_split, tables


@pytest.fixture
def splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def field(r):
    plain = "".join(r.choice("ab é5") for _ in range(r.randint(0, 6)))
    kind = r.random()
    if kind < 0.4:
        return plain.strip()
    return '"' + "".join(r.choice(["a", "bc", ",", "\n", '""', "\n\n", " ", "\r\n" if kind > 0.95 else "x"]) for _ in range(r.randint(0, 12))) + '"'


@pytest.mark.parametrize("size", [64, 300])
def test_row_for_row_as_spark(spark, splits, tmp_path, size):
    r = random.Random(size)
    for k in range(3):
        (tmp_path / "t").mkdir(exist_ok=True)
        text = 'id,"odd, name",b,c\n' + "".join(f"{k}{i},{field(r)},{field(r)},{field(r)}\n" for i in range(150))
        (tmp_path / "t" / f"{k}.csv").write_bytes(text.encode())
    (tmp_path / "t" / "long.csv").write_text('id,"odd, name",b,c\n1,"' + "one line\n" * 200 + '",x,"y"\n2,a,b,"' + "z,\n" * 100 + '"\n')
    (tmp_path / "t" / "empty.csv").write_text("")
    want = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{tmp_path}/t")
    expected = rows(want)
    splits(size)
    got = csv_split.read(spark, f"{tmp_path}/t")
    assert got.columns == want.columns and rows(got) == expected and len(expected) == 452
    assert got.rdd.getNumPartitions() > 20


def test_read_csv_chooses_by_size_and_odd_files(spark, splits, tmp_path):
    (tmp_path / "a.csv").write_text('﻿URL , Note\n\n http://a ,"x\ny"\nhttp://b,\n,"  "\n"open,1\nand on\n')
    whole = rows(tables.read_csv(spark, f"{tmp_path}/a.csv"))
    splits(16)
    x = tables.read_csv(spark, f"{tmp_path}/a.csv")
    assert x.columns == ["URL", "Note"] and rows(x)[:2] == whole[:2] and len(rows(x)) == len(whole)
    (tmp_path / "none.csv").write_text("")
    assert csv_split.read(spark, f"{tmp_path}/none.csv").columns == []


def test_transfer_of_a_line():
    for line, outside, within in (("a,b", False, True), ('a,"b', True, False), ('"', True, False), ('""', False, True), ('a"b,c', False, False), ('x","y', True, True), ('"a""', True, False), ("", False, True), ('","', False, True), ('"a"b,"c', True, True)):
        assert (csv_split.ends_quoted(line, False), csv_split.ends_quoted(line, True)) == (outside, within), line
