import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from quern.session import planned_with
from quern.sources import readers


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_lines_split_at_every_line_end(spark):
    df = spark.createDataFrame([(1, "a\r\nb\rc\nd"), (2, "")], "id int, text string")
    assert rows(readers.lines_of(df, "text", "id")) == [(1, "a"), (1, "b"), (1, "c"), (1, "d")]


@pytest.mark.parametrize("text", ["a\nb", "a\nb\n", "a\n\n", "", "\n", "a\r\n"])
def test_columns_and_files_have_the_same_lines(spark, tmp_path, text):
    (tmp_path / "x.txt").write_bytes(text.encode())
    df = spark.createDataFrame([(text,)], "text string")
    assert rows(readers.lines_of(df, "text")) == rows(readers.read_lines(spark, str(tmp_path)))


def test_read_lines_takes_files_and_folders(spark, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "x.txt").write_text("a b\nc")
    (tmp_path / "y.txt").write_text("d\n")
    df = readers.read_lines(spark, str(tmp_path / "one"), str(tmp_path / "y.txt"))
    assert rows(df) == [("a b",), ("c",), ("d",)]


def test_key_values_split_at_first_tab_only(texts):
    df = readers.parse_key_values(texts("k\tv", "k2\ta\tb", "alone", "\tv", ""))
    assert rows(df) == [("", ""), ("", "v"), ("alone", ""), ("k", "v"), ("k2", "a\tb")]


def test_ratings_keep_ids_as_strings(texts):
    df = readers.parse_ratings(texts("007,i1,4.5", "u,i2,0", "u,i3,1.0,ignored"))
    assert rows(df) == [("007", "i1", 4.5), ("u", "i2", 0.0), ("u", "i3", 1.0)]
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "string", "double"]


@pytest.mark.parametrize("bad", ["u,i,x", "u,i", ""])
def test_bad_rating_fails_or_is_dropped(texts, bad):
    with pytest.raises(Exception):
        readers.parse_ratings(texts("u,i,1", bad)).collect()
    assert rows(readers.parse_ratings(texts("u,i,1", bad), mode="permissive")) == [("u", "i", 1.0)]


def test_postings(texts):
    df = readers.parse_postings(texts("1,27233496,,0,Data-Analysis", "2,5494879,5484340,1,", "1,5077978,,-2,Big-Data"))
    assert rows(df) == [
        (1, 27233496, None, 0, "Data-Analysis"),
        (1, 5077978, None, -2, "Big-Data"),
        (2, 5494879, 5484340, 1, None),
    ]


def test_posting_tag_may_be_blank_before_a_further_field(texts):
    assert rows(readers.parse_postings(texts("1,2,,3,,x"))) == [(1, 2, None, 3, "")]


@pytest.mark.parametrize("bad", ["x,1,,0,t", "1,,,0,t", "2,1,p,0,", "1,2,,", "1"])
def test_bad_posting_fails_or_is_dropped(texts, bad):
    with pytest.raises(Exception):
        readers.parse_postings(texts(bad)).collect()
    assert rows(readers.parse_postings(texts("1,2,,3,t", bad), mode="permissive")) == [(1, 2, None, 3, "t")]


def test_unknown_mode_is_refused(texts):
    with pytest.raises(ValueError):
        readers.parse_postings(texts("1,2,,3,t"), mode="lenient")


def test_tail_field_text(texts):
    lines = texts(
        '"0","1","Mon","NO","u","hi, there,, ok"',
        "a,b,c,d,e,f,,,",
        'a,b,c,d,e," \t""padded"" \x01"',
        "a,b,c,d,e,\"",
    )
    found = [r[0] for r in readers.tail_field_text(lines).collect()]
    assert found == ["hi, there,, ok", "f", '""padded""', ""]


def test_tail_field_text_with_too_few_fields(texts):
    with pytest.raises(Exception, match="too few fields"):
        readers.tail_field_text(texts("a,b,c")).collect()
    assert readers.tail_field_text(texts("a,b,c"), mode="permissive").collect()[0][0] is None
    assert readers.tail_field_text(texts("a,b,c,d,e,,"), mode="permissive").collect()[0][0] is None


def test_short_text_csv_is_latin_1_and_may_hold_line_ends(spark, tmp_path):
    path = tmp_path / "short.csv"
    path.write_bytes('"0","1","Mon","NO","u","caf\xe9, ""so"""\n"0","2","Mon","NO","u","two\nlines"\n'.encode("latin-1"))
    assert rows(readers.read_short_text_csv(spark, str(path), multi_line=True)) == [('café, "so"',), ("two\nlines",)]


def test_word_list_limit(spark, tmp_path):
    (tmp_path / "stops").write_text("a\nb\nb\n")
    listed = readers.read_word_list(spark, str(tmp_path / "stops"))
    assert sorted(readers.as_word_list(listed)) == ["a", "b"]
    assert readers.as_word_list(listed, limit=1) is None
    assert readers.as_word_list(["x", "x", "y"]) == ["x", "y"]


def test_union_sources_is_a_bag(texts):
    both = readers.union_sources({"l": texts("a", "a"), "r": texts("a")})
    assert rows(both.groupBy("source").agg(F.count("*"))) == [("l", 2), ("r", 1)]
    with pytest.raises(ValueError):
        readers.union_sources({})


@pytest.mark.parametrize("split", ["120", "700", "128m"])
def test_records_with_line_ends_cross_split_borders(spark, tmp_path, split):
    r = random.Random(2)
    wanted = []
    for n, end in enumerate(("\n", "\r\n", "\n")):
        made = ["".join(r.choice(["a", "\xe9", '"', "\n", "\r\n", ",", '""', "word "]) for _ in range(r.randrange(14))) for _ in range(120)]
        made.append("\n" * 400 + '"' * 301)  # longer than a split
        out = io.StringIO(newline="")
        csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator=end).writerows([["0", str(i), "Mon", "NO", "user", t] for i, t in enumerate(made)])
        (tmp_path / f"{n}.csv").write_bytes(out.getvalue().encode("latin-1"))
        wanted += made
    settings = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "0"}
    with planned_with(spark, settings):
        tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
        found = [x["text"] or "" for x in readers.read_short_text_csv(spark, str(tmp_path), multi_line=True).collect()]
        ids = readers.quoted_records(spark, str(tmp_path), encoding="ISO-8859-1").select("file", "record_id").collect()
    assert sorted(found) == sorted(wanted)
    assert len(set(ids)) == len(ids) == len(wanted)
    assert tasks > 20 or split == "128m"


def test_records_of_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"")
    (tmp_path / "b.csv").write_bytes(b'\n"0","1","2","3","4","x"\n\n')
    assert rows(readers.read_short_text_csv(spark, str(tmp_path), multi_line=True)) == [("x",)]


BROKEN = ["1,2,,3,t", "x,2,,3", "1,y,,3", "1,2,?,3", "1,2,,z", "1,2", "", None]


def test_every_line_is_kept_or_rejected_with_a_reason(spark, tmp_path):
    lines = spark.createDataFrame([(b,) for b in BROKEN], "value string")
    checked, seen = readers.count_lines(readers.checked_postings(lines))
    checked.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"lines": 8, "kept": 1, "rejected": 7}
    found = spark.read.parquet(str(tmp_path / "out"))
    assert rows(readers.kept_lines(found)) == [(1, 2, None, 3, "t")]
    assert rows(readers.rejected_lines(found)) == sorted(
        [
            ("type is no number", "x,2,,3"), ("id is no number", "1,y,,3"), ("parent is no number", "1,2,?,3"),
            ("score is no number", "1,2,,z"), ("too few fields", "1,2"), ("too few fields", ""), ("no line", None),
        ],
        key=repr,
    )


def test_reasons_of_ratings_and_short_texts(texts):
    assert rows(readers.checked_ratings(texts("u,i,1", "u,i", "u,i,x")).select("reason", "rating")) == sorted(
        [(None, 1.0), ("too few fields", None), ("rating is no number", None)], key=repr
    )
    assert rows(readers.checked_tail_fields(texts('a,b,c,d,e,"f,g"', "a,b")).select("reason", "text")) == sorted(
        [(None, "f,g"), ("too few fields", None)], key=repr
    )
