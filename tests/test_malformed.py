import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.sources import read_csv, read_csv_checked, typed_schema

SCHEMA = typed_schema({"k": "int", "name": "string", "amount": T.DecimalType(10, 2), "day": "date"})
GOOD = ["1;a;1.50;2024-01-31", "2;;;", "3;\"x;y\";2;2024-02-29"]
BAD = {
    "4;short": "wrong number of fields",
    "5;too;1.0;2024-01-01;long": "wrong number of fields",
    "six;b;1.0;2024-01-01": "malformed value: k",
    "7;c;much;2024-13-01": "malformed value: amount, day",
    "  8x ; é ;1;2024-01-01": "malformed value: k",
    "99999999999;d;1;2024-01-01": "malformed value: k",
    "just text": "wrong number of fields",
}


@pytest.mark.parametrize("header", [True, False])
def test_every_bad_line_comes_back_word_for_word(spark, tmp_path, header):
    folder = tmp_path / "in"
    folder.mkdir()
    head = "k;name;amount;day\n" if header else ""
    (folder / "a.csv").write_text(head + "\n".join([*GOOD, *BAD]) + "\n", encoding="utf-8")
    (folder / "b.csv").write_text(head + "\n".join(GOOD) + "\n", encoding="utf-8")
    read = read_csv_checked(spark, str(folder), SCHEMA, header=header, sep=";")
    bad = read.malformed.collect()
    assert {r.line: r.reason for r in bad} == BAD and len(bad) == len(BAD)
    assert all(r.file.endswith("/a.csv") and r.block == 0 for r in bad)
    good = [tuple(map(str, r)) for r in read.rows.collect()]
    assert sorted(good) == sorted(2 * [("1", "a", "1.50", "2024-01-31"), ("2", "None", "None", "None"), ("3", "x;y", "2.00", "2024-02-29")])


def test_selecting_few_columns_sees_the_same_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([*GOOD, *BAD]) + "\n", encoding="utf-8")
    read = read_csv_checked(spark, str(tmp_path / "a.csv"), SCHEMA, header=False, sep=";")
    assert read.rows.select("name").count() == 3 and read.malformed.select("line").count() == len(BAD)
    assert read.rows.agg(F.count(F.lit(1))).first()[0] == 3
    # a plain read shows them as rows of NULLs
    assert read_csv(spark, str(tmp_path / "a.csv"), header=False, sep=";", schema=SCHEMA).count() == 10


def test_empty_files_and_blank_lines(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n\n1;a;1;2024-01-01\n\n")
    for name, n in (("empty.csv", 0), ("blank.csv", 1)):
        read = read_csv_checked(spark, str(tmp_path / name), SCHEMA, header=False, sep=";")
        assert (read.rows.count(), read.malformed.count()) == (n, 0)
