"""Newlines inside quotes, read by many tasks a file, against Spark's one-task reader."""

import random

import pytest

from tessera.sources.csv import read_csv, read_csv_sniffed, read_multi_line_csv, sniff_text
from tessera.sources.csv_lines import quoted_lines, stray_quotes


def write(folder, name, rows, head="id;text;more"):
    with open(folder / name, "w", encoding="utf-8", newline="") as f:
        f.write(head + "\n" + "".join(r + "\n" for r in rows))


def made(rng, n, name):
    out = []
    for i in range(n):
        text = rng.choice(["plain", '"quoted ; text"', '"two\nlines"', '"a ""said"" b"', '""', "",
                           '"\n\nthree\n;ends\n"', "é ü", '"opens ""\n"" again"',
                           '"' + "long line\n" * rng.choice([1, 40]) + '"'])
        out.append(f"{name}{i};{text};{rng.choice(['x', '', '\"y\nz\"'])}")
        if rng.random() < 0.05:  # a blank record
            out.append("")
    return out


def same(one, two):
    return sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "300")
    spark.conf.set(keys[1], "0")
    yield
    for k, v in zip(keys, before, strict=True):
        spark.conf.set(k, v)


def test_rows_equal_the_one_task_reader(spark, tmp_path, small_splits):
    rng = random.Random(3)
    for name in ("a b.csv", "c.csv"):
        write(tmp_path, name, [*made(rng, 60, name[0]),
                               f'{name};"{"very long " * 3000}{chr(34) * 4000}\n";x'])
    path = str(tmp_path)
    lines = quoted_lines(spark, path, ";", "UTF-8")
    assert lines.select("file", "block").distinct().count() > 20
    assert stray_quotes(lines).count() == 0
    want = read_csv(spark, path, encoding="UTF-8", multi_line=True)
    assert same(read_multi_line_csv(spark, path, encoding="UTF-8"), want)
    assert same(read_csv_sniffed(spark, path), want)


def test_a_stray_quote_is_reported_and_touches_its_file_only(spark, tmp_path, small_splits):
    rng = random.Random(5)
    write(tmp_path, "good.csv", made(rng, 30, "g"))
    write(tmp_path, "odd one.csv", ['1;a 5" pipe;x', '2;"two\nlines";y', "3;z;"])
    write(tmp_path, "even.csv", ['1;a 5" pipe;x', "2;plain;y", '3;a 6" pipe;z'])
    path = str(tmp_path)
    found = stray_quotes(quoted_lines(spark, path, ";", "UTF-8")).collect()
    assert sorted(r["file"].rsplit("/", 1)[1] for r in found) == ["even.csv", "odd%20one.csv"]
    assert same(read_multi_line_csv(spark, path, encoding="UTF-8"),
                read_csv(spark, path, encoding="UTF-8", multi_line=True))


def test_headers_must_agree(spark, tmp_path):
    write(tmp_path, "a.csv", ['1;"x\ny";z'])
    write(tmp_path, "b.csv", ['1;"x\ny";z'], head="id;other;more")
    with pytest.raises(ValueError, match="different headers"):
        read_multi_line_csv(spark, str(tmp_path), encoding="UTF-8").collect()


def test_latin_1_lines_are_decoded_and_their_quotes_counted(spark, tmp_path):
    # the byte of É begins a longer sign in UTF-8, so the quote after it was not counted
    for name, text, several in (("one", 'id;text\n1;"É"\n', False),
                                ("two", 'id;text\n1;"É x\nß y"\n2;"ä z"\n', True)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.csv").write_bytes(text.encode("iso-8859-1"))
        assert sniff_text(spark, str(tmp_path / name)) == ("ISO-8859-1", several)
    got = read_csv_sniffed(spark, str(tmp_path / "two")).collect()
    assert sorted(map(tuple, got)) == [("1", "É x\nß y"), ("2", "ä z")]
