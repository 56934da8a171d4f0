"""Records whose cells hold line breaks, wherever a file is split."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from plumbline.sources import readers

PIECES = ["a", "b;c", "two\nlines", "x\n\ny", 'say "no"', '""', '"', ";", "\n", "plain", "5' long", "\n;\"\n", "é漢"]


def written(rows, stray):
    """Rows as delimited text: cells quoted where they must be, some others too; with ``stray``, some cells that need no
    quotes hold one in the middle."""
    rng = random.Random(7)
    lines = []
    for row in rows:
        cells = []
        for c in row:
            must = any(x in c for x in ';\n"')
            if stray and not must and c and rng.random() < 0.3:
                cells.append(c + '" more')
            elif must or rng.random() < 0.2:
                cells.append('"' + c.replace('"', '""') + '"')
            else:
                cells.append(c)
        lines.append(";".join(cells))
    return "\n".join(lines) + "\n"


@pytest.fixture
def small_splits(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
    yield use
    for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{name}")


@pytest.mark.parametrize("size", [97, 1 << 20])
@pytest.mark.parametrize("stray", [False, True])
def test_wide_export_equals_a_plain_reader(spark, tmp_path, small_splits, size, stray):
    rng = random.Random(3)
    texts = {}
    for name in "ab":
        rows = [[name + str(i), *("".join(rng.choices(PIECES, k=rng.randint(1, 2))) for _ in range(2))] for i in range(60)]
        texts[name] = written(rows, stray)
        preamble = "".join(f'about "{i}\n' for i in range(7))
        (tmp_path / f"{name}.csv").write_text(preamble + 'PID;"one\ntwo";three\n' + texts[name], encoding="utf8")
    small_splits(size)
    wide = readers.read_wide_export(spark, str(tmp_path))
    if size < 1000:
        assert wide.select(F.col("row_ord.start")).distinct().count() > 8
    assert wide.columns == ["PID", "one\ntwo", "three", "row_ord"]
    got = wide.orderBy("row_ord").collect()
    want = [r for name in "ab" for r in csv.reader(io.StringIO(texts[name], newline=""), delimiter=";")]
    assert [list(r)[:3] for r in got] == want


def test_long_export_with_line_breaks(spark, tmp_path, small_splits, rows):
    path = tmp_path / "long.csv"
    path.write_text('﻿PID;Episode;Episode_Date;IX;source_id;source_value;more\n'
                    '1;1;d;1;A;"x;\ny";z\n\n1;1;NA;1;A;;\n2;1;d;1;"B";"\n";z\n', encoding="utf8")
    small_splits(16)
    assert rows(readers.read_long_export(spark, str(path)), "PID", "Episode_Date", "source_id", "source_value") == sorted(
        [("1", "d", "A", "x;\ny"), ("1", None, "A", None), ("2", "d", "B", "\n")], key=str)
    path.write_text("PID;x\n1;2\n")
    with pytest.raises(ValueError, match="lacks the columns"):
        readers.read_long_export(spark, str(path))


def test_a_cell_longer_than_many_splits(spark, tmp_path, small_splits):
    body = "\n".join(f"line {i}" for i in range(400))
    path = tmp_path / "wide.csv"
    path.write_text("x\n" * 7 + f'PID;A\n1;"{body}"\n2;b\n', encoding="utf8")
    small_splits(128)
    got = readers.read_wide_export(spark, str(path)).orderBy("row_ord").collect()
    assert [(r.PID, r.A) for r in got] == [("1", body), ("2", "b")]


def test_a_cell_that_never_ends_stops_the_job(spark, tmp_path, small_splits):
    path = tmp_path / "wide.csv"
    path.write_text("x\n" * 7 + 'PID;A\n1;"b\n2;c\n3;d\n', encoding="utf8")
    small_splits(16)
    with pytest.raises(Exception, match="a quoted cell never ends"):
        readers.read_wide_export(spark, str(path)).collect()


def test_what_a_line_does_to_the_state(spark):
    """Both answers against a character by character reading."""
    def plain(text, inside):
        state = "quoted" if inside else "start"
        i = 0
        while i < len(text):
            c = text[i]
            if state == "quoted":
                if c == '"' and text[i + 1:i + 2] == '"':
                    i += 1
                elif c == '"':
                    state = "cell"
            elif c == ";":
                state = "start"
            elif state == "start" and c == '"':
                state = "quoted"
            else:
                state = "cell"
            i += 1
        return state == "quoted"

    rng = random.Random(1)
    texts = ["".join(rng.choices('a;"', k=rng.randint(0, 9))) for _ in range(3000)]
    # A doubled quote that does not start a cell and stands in none is read as text by either.
    outside, inside = readers._inside_after(F.col("t"), ";")
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", outside.alias("o"), inside.alias("i")).collect()
    odd = [r.t for r in got if (r.o, r.i) != (plain(r.t, False), plain(r.t, True))]
    assert odd == []
