"""CSV with line breaks inside quotes: many splits against one task per file."""

import random

import pytest

from cardrail.schemas import OPERATION_COLUMNS
from cardrail.sources import operations, quoted_lines

FIELDS = ["plain", "", "a,b", 'say "hi"', "two\nlines", "\n", '"\n"', "end\n\n", 'a "q\nw" b,c', "  spaced ", "NA", "ä\nß", "x" * 900 + "\n" + "y" * 900]


def quoted(field):
    return '"' + field.replace('"', '""') + '"' if any(c in field for c in ',"\n') else field


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def write(path, rows, line="\n", blank=False):
    lines = ["k,one,two", *(",".join([str(k), *map(quoted, r)]) for k, r in enumerate(rows))]
    text = (line * (2 if blank else 1)).join(lines) + line
    path.write_bytes(text.encode())


@pytest.mark.parametrize("seed", range(3))
def test_all_records_of_many_splits(spark, tmp_path, small_splits, seed):
    draw = random.Random(seed)
    files = [[(draw.choice(FIELDS), draw.choice(FIELDS)) for _ in range(n)] for n in (400, 1, 0, 150)]
    for k, rows in enumerate(files):
        write(tmp_path / f"f{k}.csv", rows, blank=k == 3)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 40
    found = operations.scan_quoted(spark, str(tmp_path), "row").orderBy("row").collect()
    want = [(str(k), *(f or None for f in r)) for rows in files for k, r in enumerate(rows)]
    assert [r.row for r in found] == list(range(len(want)))
    # a blank line inside a quoted field belongs to it, one between records does not
    assert [tuple(r)[1:] for r in found] == want


def test_a_field_over_many_splits(spark, tmp_path, small_splits):
    rows = [("short", "x"), ("line\n" * 5_000, "y"), ('"\n' * 3_000, "z"), ("last", "w")]
    write(tmp_path / "f.csv", rows)
    found = operations.scan_csv(spark, str(tmp_path), multiline=True).collect()
    assert sorted((r.k, r.one, r.two) for r in found) == [(str(k), *r) for k, r in enumerate(rows)]


def test_line_ends_of_two_characters(spark, tmp_path, small_splits):
    rows = [("a", "b\nc"), ("d", ""), ("", "e")] * 200
    write(tmp_path / "f.csv", rows, line="\r\n")
    found = operations.scan_quoted(spark, str(tmp_path), "row").orderBy("row").collect()
    assert [(r.one, r.two) for r in found] == [(a or None, b or None) for a, b in rows]


def test_equals_the_reader_of_whole_files(spark, tmp_path, small_splits):
    draw = random.Random(9)
    write(tmp_path / "f.csv", [(draw.choice(FIELDS), draw.choice(FIELDS)) for _ in range(300)])
    whole = spark.read.options(header="true", quote='"', escape='"', multiLine="true", nullValue="").csv(str(tmp_path))
    found = operations.scan_csv(spark, str(tmp_path), multiline=True)
    assert found.columns == whole.columns and sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def test_header_only_and_unclosed_quote(spark, tmp_path):
    write(tmp_path / "f.csv", [])
    assert operations.scan_csv(spark, str(tmp_path), multiline=True).count() == 0
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "f.csv").write_text('a,b\n1,2\n3,"open\nmore\n4,5\n')
    texts = [r.value for r in quoted_lines.records(spark, str(tmp_path / "g")).orderBy("number").collect()]
    assert texts == ["a,b", "1,2", '3,"open\nmore\n4,5']


def test_bulk_load_with_line_breaks(spark, tmp_path, small_splits):
    fields = [quoted(FIELDS[i % len(FIELDS)]) or '""' for i in range(len(OPERATION_COLUMNS))]
    (tmp_path / "f.csv").write_text("\n".join([",".join(OPERATION_COLUMNS), *[",".join(fields)] * 60]) + "\n")
    rows = operations.bulk_load(spark, str(tmp_path), multiline=True).collect()
    assert len(rows) == 60 and len({r.id for r in rows}) == 60
    assert [rows[7][c] for c in OPERATION_COLUMNS] == [FIELDS[i % len(FIELDS)] for i in range(len(OPERATION_COLUMNS))]
    (tmp_path / "f.csv").write_text(",".join(OPERATION_COLUMNS) + "\n" + ",".join(fields[:-1]) + "\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        operations.bulk_load(spark, str(tmp_path), multiline=True).collect()
