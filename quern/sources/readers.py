"""Scans and line parsers.

Every parser takes a DataFrame with one text column, so it works on files read as text and on text
columns of tables alike. `mode="strict"` fails on a bad line; `mode="permissive"` drops it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import text as tx
from quern.session import stage

SHORT_TEXT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("f0", "f1", "f2", "f3", "f4", "text")])

LATIN_1 = "ISO-8859-1"

#: Longest word list that is brought to the driver or put into a plan as literals.
WORD_LIST_LIMIT = 20_000


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Text files or folders, one row per line: `value`."""
    return spark.read.text(list(paths))


def lines_of(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """The lines of a text column: `keep…, value`."""
    return df.select(*keep, F.explode(tx.text_lines(F.col(column))).alias("value"))


def parse_key_values(lines: DataFrame, column: str = "value") -> DataFrame:
    """`key, value` split at the first tab; a line without a tab is all key."""
    parts = F.split(F.col(column), "\t", 2)
    return lines.select(F.get(parts, 0).alias("key"), F.coalesce(F.get(parts, 1), F.lit("")).alias("value"))


def read_key_values(spark: SparkSession, *paths: str) -> DataFrame:
    return parse_key_values(read_lines(spark, *paths))


def _check_mode(mode: str) -> bool:
    if mode not in ("strict", "permissive"):
        raise ValueError(f"mode must be 'strict' or 'permissive', not {mode!r}")
    return mode == "strict"


def checked_ratings(lines: DataFrame, column: str = "value") -> DataFrame:
    """`value, reason, user_id, item_id, rating`: every line, with why it can't be read, or NULL (S3)."""
    parts = lines.select(F.col(column).alias("value"), tx.fields(F.col(column)).alias("f"))
    rating = F.get("f", F.lit(2)).try_cast("double")
    reason = F.when(F.col("value").isNull(), "no line").when(F.size("f") < 3, "too few fields").when(
        rating.isNull(), "rating is no number"
    )
    ids = [F.get("f", F.lit(i)).alias(n) for i, n in enumerate(("user_id", "item_id"))]
    return parts.select("value", reason.alias("reason"), *ids, rating.alias("rating"))


def checked_postings(lines: DataFrame, column: str = "value") -> DataFrame:
    """`value, reason, posting_type, id, parent_id, score, tag`: every line, with why it can't be read, or NULL."""
    parts = lines.select(F.col(column).alias("value"), tx.fields(F.col(column)).alias("f"))
    at = lambda i: F.get("f", F.lit(i))
    kind, number, score = at(0).try_cast("int"), at(1).try_cast("bigint"), at(3).try_cast("int")
    parent = tx.blank_to_null(at(2))
    reason = (
        F.when(F.col("value").isNull(), "no line")
        .when(F.size("f") < 4, "too few fields")
        .when(kind.isNull(), "type is no number")
        .when(number.isNull(), "id is no number")
        .when(parent.isNotNull() & parent.try_cast("bigint").isNull(), "parent is no number")
        .when(score.isNull(), "score is no number")
    )
    return parts.select(
        "value", reason.alias("reason"), kind.alias("posting_type"), number.alias("id"),
        parent.try_cast("bigint").alias("parent_id"), score.alias("score"), at(4).alias("tag"),
    )


def checked_tail_fields(lines: DataFrame, *keep: str, column: str = "value", skip: int = 5) -> DataFrame:
    """`keep…, value, reason, text`: every line, with why it can't be read, or NULL."""
    parts = lines.select(*keep, F.col(column).alias("value"), tx.fields(F.col(column)).alias("f"))
    reason = F.when(F.col("value").isNull(), "no line").when(F.size("f") <= skip, "too few fields")
    text = F.when(F.size("f") > skip, tx.unquote(tx.rest_of_fields(F.col("f"), skip + 1)))
    return parts.select(*keep, "value", reason.alias("reason"), text.alias("text"))


def kept_lines(checked: DataFrame) -> DataFrame:
    """What the lines that can be read say."""
    return checked.where("reason IS NULL").drop("value", "reason")


def rejected_lines(checked: DataFrame) -> DataFrame:
    """`reason, value` of the lines that can't be read, for an output of their own."""
    return checked.where("reason IS NOT NULL").select("reason", "value")


def count_lines(checked: DataFrame, name: str = "lines") -> tuple[DataFrame, Observation]:
    """`checked` and its counts `lines, kept, rejected`, which are there once a job has read all of it, whatever that job
    writes: no second pass is needed to know how much was dropped."""
    seen = Observation(name)
    bad = F.count(F.col("reason"))
    counts = [F.count(F.lit(1)).alias("lines"), (F.count(F.lit(1)) - bad).alias("kept"), bad.alias("rejected")]
    return checked.observe(seen, *counts), seen


def parse_ratings(lines: DataFrame, column: str = "value", mode: str = "strict") -> DataFrame:
    """`user_id, item_id, rating` from 'user,item,rating' lines; ids stay strings (S3)."""
    if not _check_mode(mode):
        return kept_lines(checked_ratings(lines, column))
    f = F.col("f")
    parts = lines.select(tx.fields(F.col(column)).alias("f"))
    return parts.select(f[0].alias("user_id"), f[1].alias("item_id"), f[2].cast("double").alias("rating"))


def read_ratings(spark: SparkSession, *paths: str, mode: str = "strict") -> DataFrame:
    return parse_ratings(read_lines(spark, *paths), mode=mode)


def parse_postings(lines: DataFrame, column: str = "value", mode: str = "strict") -> DataFrame:
    """`posting_type, id, parent_id, score, tag` from 'type,id,parent,score,tag' lines.

    An empty parent and a missing tag are NULL.
    """
    if not _check_mode(mode):
        return kept_lines(checked_postings(lines, column))
    f = F.col("f")
    parts = lines.select(tx.fields(F.col(column)).alias("f"))
    return parts.select(
        f[0].cast("int").alias("posting_type"),
        f[1].cast("bigint").alias("id"),
        tx.blank_to_null(f[2]).cast("bigint").alias("parent_id"),
        f[3].cast("int").alias("score"),
        F.get("f", F.lit(4)).alias("tag"),
    )


def read_postings(spark: SparkSession, *paths: str, mode: str = "strict") -> DataFrame:
    return parse_postings(read_lines(spark, *paths), mode=mode)


def tail_field_text(
    lines: DataFrame, *keep: str, column: str = "value", skip: int = 5, mode: str = "strict"
) -> DataFrame:
    """`keep…, text`: all fields after the first `skip`, commas restored, unquoted, trimmed.

    A line with too few fields is an error, or a NULL text when permissive.
    """
    if not _check_mode(mode):
        return checked_tail_fields(lines, *keep, column=column, skip=skip).drop("value", "reason")
    parts = lines.select(*keep, tx.fields(F.col(column)).alias("f"))
    found = tx.unquote(tx.rest_of_fields(F.col("f"), skip + 1))
    short = F.raise_error(F.lit("too few fields in a short-text line")).cast("string")
    return parts.select(*keep, F.when(F.size("f") > skip, found).otherwise(short).alias("text"))


def read_short_text_csv(spark: SparkSession, *paths: str, multi_line: bool = False) -> DataFrame:
    """Last column of a quoted latin-1 CSV: `text`.

    With `multi_line` quoted fields may hold line ends. Spark splits large files either way.
    """
    options = {"quote": '"', "escape": '"'}
    if not multi_line:
        return spark.read.csv(list(paths), schema=SHORT_TEXT_SCHEMA, encoding=LATIN_1, **options).select("text")
    records = quoted_records(spark, *paths, encoding=LATIN_1)
    fields = F.from_csv("record", SHORT_TEXT_SCHEMA.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {**options, "multiLine": "true"})
    return records.select(fields.alias("f")).select("f.text")


def quoted_records(spark: SparkSession, *paths: str, encoding: str = "UTF-8") -> DataFrame:
    """`file, record_id, record`: the records of quoted text files, whose quoted fields may hold line ends.

    A line is inside a quoted field if an odd number of quotes stands before it in its file; doubled quotes don't change
    that. So files are read in splits like any text: each split counts its quotes, splits of a file are put in order by one
    row each, and lines learn from that sum where they are. Lines that are records of their own go no further; the others
    are gathered record by record. Line ends are line feeds, or carriage returns and line feeds; a carriage return at the
    end of a record goes. A quote inside a field that isn't quoted isn't allowed. Empty lines between records are no
    records; `record_id` is increasing in each file.
    """
    lines = spark.read.option("lineSep", "\n").text(list(paths))
    split = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        F.decode(F.col("value").cast("binary"), encoding).alias("value"),
    ).withColumn("odd", F.expr("(length(value) - length(replace(value, '\"', ''))) % 2").cast("int"))
    # A split is bounded by spark.sql.files.maxPartitionBytes, and so is its window.
    so_far = Window.partitionBy("file", "start").orderBy("at")
    before = so_far.rowsBetween(Window.unboundedPreceding, -1)
    inside = split.withColumn("parity", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    # Lines that begin a record if the split begins outside of quotes, and if it begins inside.
    begins = [F.sum((F.col("parity") == p).cast("long")).over(so_far).alias(f"begun{p}") for p in (0, 1)]
    placed = stage(inside.select("*", *begins), "split-lines")

    per_split = placed.groupBy("file", "start").agg(
        F.sum("odd").alias("quotes"), F.max("begun0").alias("all0"), F.max("begun1").alias("all1")
    )
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    entered = per_split.withColumn("entry", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).cast("int"))
    own = F.when(F.col("entry") == 0, F.col("all0")).otherwise(F.col("all1"))
    ordered = entered.withColumn("first", F.coalesce(F.sum(own).over(earlier), F.lit(0))).select(
        F.col("file").alias("in_file"), F.col("start").alias("in_start"), "entry", "first"
    )
    met = placed.join(ordered, (F.col("file") == F.col("in_file")) & (F.col("start") == F.col("in_start")))
    state = met.select(
        "file", "start", "at", "value",
        (F.col("first") + F.when(F.col("entry") == 0, F.col("begun0")).otherwise(F.col("begun1"))).alias("record_id"),
        (((F.col("parity") + F.col("entry")) % 2 == 0) & (F.col("odd") == 0)).alias("alone"),
    )
    ended = F.regexp_replace("value", "\\r\\z", "")
    single = state.where("alone").select("file", "record_id", ended.alias("record")).where("record <> ''")
    parts = F.array_sort(F.collect_list(F.struct("start", "at", "value")))
    joined = F.array_join(F.transform(parts, lambda p: p["value"]), "\n")
    several = state.where("not alone").groupBy("file", "record_id").agg(joined.alias("value"))
    return single.unionByName(several.select("file", "record_id", ended.alias("record")))


def read_word_list(spark: SparkSession, *paths: str) -> DataFrame:
    """A side input of one word per line: `word`."""
    return read_lines(spark, *paths).select(F.col("value").alias("word"))


def as_word_list(words: DataFrame | Iterable[str], limit: int = WORD_LIST_LIMIT) -> list[str] | None:
    """The words on the driver when there are at most `limit` of them, else None."""
    if isinstance(words, DataFrame):
        found = [r[0] for r in words.select(words.columns[0]).distinct().limit(limit + 1).collect()]
    else:
        found = sorted(set(words))
    return found if len(found) <= limit else None


def word_frame(spark: SparkSession, words: DataFrame | Iterable[str], column: str = "word") -> DataFrame:
    """The distinct words as a DataFrame."""
    if not isinstance(words, DataFrame):
        words = spark.createDataFrame([(w,) for w in words], "word string")
    return words.select(F.col(words.columns[0]).alias(column)).distinct()


def union_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Bag union of same-shaped inputs with a `source` column naming each."""
    if not sources:
        raise ValueError("no sources given")
    whole: DataFrame | None = None
    for name, df in sources.items():
        part = df.withColumn("source", F.lit(name))
        whole = part if whole is None else whole.unionByName(part)
    return whole
