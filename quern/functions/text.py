"""Text and field expressions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# The delimiter sets of the two word splitters and the line ends.
WHITESPACE_DELIMITERS = "[ \t\n\r\f]+"
SPACE_OR_LINE_END = "[ \r\n]+"
LINE_END = "\r\n|\r|\n"
# Fixed value: everything up to U+0020 counts as blank when a text is trimmed.
TRIM_BLANKS = r"^[\x00-\x20]+|[\x00-\x20]+\z"


def whitespace_words(text: Column) -> Column:
    """Pieces between blanks, tabs, line ends and form feeds; the ends may yield '' (F1)."""
    return F.split(text, WHITESPACE_DELIMITERS)


def space_words(text: Column) -> Column:
    """Pieces between single spaces within each line, so tabs and punctuation stay in (F2)."""
    return F.split(text, SPACE_OR_LINE_END)


def text_lines(text: Column) -> Column:
    """The lines of a text, as a file with it has them: a final line end starts no line, an empty text has none."""
    pieces = F.split(text, LINE_END)
    return F.when(F.get(pieces, F.size(pieces) - 1) == "", F.slice(pieces, 1, F.size(pieces) - 1)).otherwise(pieces)


def fields(line: Column) -> Column:
    """Comma-separated fields without the empty ones at the end (F2)."""
    return F.split(F.rtrim(line, F.lit(",")), ",")


def blank_to_null(value: Column) -> Column:
    """'' becomes NULL."""
    return F.nullif(value, F.lit(""))


def unquote(value: Column) -> Column:
    """Drop one quote at either end, then trim."""
    return F.regexp_replace(F.regexp_replace(value, r'^"|"\z', ""), TRIM_BLANKS, "")


def rest_of_fields(parts: Column, first: int) -> Column:
    """Fields from the 1-based position `first` on, joined by commas again."""
    return F.array_join(F.slice(parts, first, F.greatest(F.size(parts), F.lit(1))), ",")


def pairs_to_text(pairs: Column, left: str, right: str) -> Column:
    """`[{left, right}, …]` as 'left:right,left:right' (F11)."""
    return F.array_join(
        F.transform(pairs, lambda p: F.concat_ws(":", p[left].cast("string"), p[right].cast("string"))), ","
    )


def vector_to_text(vector: Column) -> Column:
    """An ML vector as '[a,b]' (F12)."""
    return F.concat(F.lit("["), F.array_join(vector_to_array(vector).cast("array<string>"), ","), F.lit("]"))
