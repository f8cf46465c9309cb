"""Spelling variants: words one edit apart, found by an index of variable-length grams."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_texts, raw_bytes
from quern.session import broadcast_if_small, stage

#: Lengths of grams. One edit changes at most `LONGEST` grams of a word, and a word of n characters has
#: n + 3 - `SHORTEST` of them, so words of six characters or more keep at least one.
SHORTEST, LONGEST = 3, 5
#: A gram in more than so many places of the vocabulary is extended by the next character.
FREQUENT = 64
#: Most grams the broadcast dictionary holds; its threshold rises with the vocabulary to stay below.
DICTIONARY = 200_000
#: Words of one list that are paired as they are. Longer lists are divided by the half of the word that an edit leaves
#: alone, and those of them that are still long by the word with one character left out.
LONG_LIST = 128
#: Ends of a word.
_FIRST, _LAST = "^", "$"

# Fixed value: the characters of a run of letters.
_LETTERS = "A-Za-z\u00C0-\u00FF"


def vocabulary(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", drop_one_in: int = 199, shortest: int = 6, least: int = 5
) -> DataFrame:
    """`word, n`: lower-cased runs of letters of `shortest` or more characters that occur at least `least` times.

    Runs whose digest with the document's id is divisible by `drop_one_in` lose the character that the digest picks.
    Null texts have no words; a null id counts as the empty text. Repeated rows count as often as they occur. Each batch of
    texts is counted where it is; only its different words are shuffled.
    """
    run_of = re.compile(f"[{_LETTERS}]{{{shortest},}}")

    def count(batches):
        for batch in batches:
            found: Counter[str] = Counter()
            for key, body in zip(batch.column(0).to_pylist(), raw_bytes(batch.column(1)), strict=True):
                start = zlib.crc32(f"{key}:".encode())
                for word, n in Counter(run_of.findall(body.lower().decode())).items():
                    digest = zlib.crc32(word.encode(), start)
                    if digest % drop_one_in == 0:
                        at = digest % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < shortest:
                            continue
                    found[word] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    texts = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("body"))
    counted = map_texts(texts, count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


def _marked(word: Column) -> Column:
    return F.concat(F.lit(_FIRST), word, F.lit(_LAST))


def frequent_grams(words: DataFrame, frequent: int = FREQUENT, dictionary: int = DICTIONARY) -> dict[str, int]:
    """The grams that occur more than `frequent` times in the distinct `words`, with their counts.

    The threshold is raised so that no more than `dictionary` grams can pass it, whatever the words are.
    """
    sizes = range(SHORTEST, LONGEST + 1)
    places = [F.transform(F.sequence(F.lit(1), F.length("marked") - (q - 1)), lambda p, q=q: F.substring(F.col("marked"), p, F.lit(q))) for q in sizes]
    # A word and its marks are at least as long as the longest gram, as `candidates` demands.
    grams = words.select(_marked(F.col("word")).alias("marked")).select(F.explode(F.concat(*places)).alias("gram"))
    total = words.agg(F.sum(len(sizes) * F.length("word"))).first()[0] or 0
    most = max(frequent, -(-total // dictionary))
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > most)
    return {r["gram"]: r["c"] for r in counts.collect()}


def decompose(word: str, frequent: Mapping[str, int]) -> list[tuple[str, int]]:
    """The variable grams of a marked word, `gram, place`: one at each place, extended while it is frequent.

    A gram depends on its own characters alone, so an edit changes those that cover it and no others.
    """
    found = []
    for start in range(len(word) - SHORTEST + 1):
        end = start + SHORTEST
        while end < len(word) and end - start < LONGEST and word[start:end] in frequent:
            end += 1
        found.append((word[start:end], start))
    return found


def affected(grams: list[tuple[str, int]], size: int) -> int:
    """Most grams that one edit of a marked word of `size` characters can change: those over its most covered character."""
    covering = [0] * (size + 1)
    for gram, start in grams:
        covering[start] += 1
        covering[start + len(gram)] -= 1
    most = now = 0
    for change in covering[: size - 1]:
        now += change
        most = max(most, now)
    return most


def rare_grams(word: str, frequent: Mapping[str, int]) -> list[tuple[str, int]]:
    """The grams by which a word finds all words one edit away.

    Two such words share all grams but those their edit affects. In an order of grams that is the same for all words,
    rare ones first, only affected grams come before the first shared one. So both words have it among their first
    `affected` + 1 grams; grams equal to the last of these count as well.
    """
    marked = f"{_FIRST}{word}{_LAST}"
    grams = decompose(marked, frequent)
    bound = affected(grams, len(marked))
    order = sorted((frequent.get(gram, 0), -len(gram), gram, at) for gram, at in grams)
    if bound >= len(order):
        raise ValueError(f"{word!r} is too short for grams of {SHORTEST} to {LONGEST} characters")
    return [(gram, at) for c, size, gram, at in order if (c, size, gram) <= order[bound][:3]]


def _postings(words: DataFrame, frequent: Mapping[str, int]) -> DataFrame:
    """`key, long, word, n`: the index lists. A list is that of a gram, its place and the length of a pair's shorter word.

    A longer word stands in the lists of words one character shorter, for a gram before the edit and for one behind it.
    """
    known = words.sparkSession.sparkContext.broadcast(frequent)

    def grams_of(batches):
        for batch in batches:
            rare = [rare_grams(w, known.value) for w in batch.column(0).to_pylist()]
            names = pa.array([[g for g, _ in r] for r in rare], pa.list_(pa.string()))
            places = pa.array([[at for _, at in r] for r in rare], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, names, places], ["word", "n", "grams", "places"])

    split = words.select("word", "n").mapInArrow(grams_of, "word string, n long, grams array<string>, places array<int>")
    each = split.select("word", "n", F.inline(F.arrays_zip("grams", "places"))).withColumnsRenamed({"grams": "gram", "places": "place"})
    size = F.length("word")
    lists = F.array(
        F.struct(F.lit(False).alias("long"), F.xxhash64("gram", "place", size).alias("key")),
        F.struct(F.lit(True).alias("long"), F.xxhash64("gram", "place", size - 1).alias("key")),
        F.struct(F.lit(True).alias("long"), F.xxhash64("gram", F.col("place") - 1, size - 1).alias("key")),
    )
    return each.select("word", "n", F.inline(lists))


def _without_one(postings: DataFrame) -> DataFrame:
    """The rows of long lists in lists of their own for each word without one character: pairs one edit apart meet there.

    Words of one length meet without the character at the same place, and a longer one without any meets the shorter one.
    """
    places = F.sequence(F.lit(1), F.length("word"))
    left = lambda p: F.concat(F.substring(F.col("word"), F.lit(1), p - 1), F.substring(F.col("word"), p + 1, F.length("word")))
    whole = F.array(F.struct(F.lit(0).alias("cut"), F.col("word").alias("rest")))
    shorter = F.concat(F.transform(places, lambda p: F.struct(p.alias("cut"), left(p).alias("rest"))), whole)
    longer = F.transform(places, lambda p: F.struct(F.lit(0).alias("cut"), left(p).alias("rest")))
    met = postings.select("key", "long", "word", "n", F.inline(F.when(F.col("long"), longer).otherwise(shorter)))
    return met.select(F.xxhash64("key", "cut", "rest").alias("key"), "long", "word", "n")


def _by_half(postings: DataFrame) -> DataFrame:
    """The rows of long lists in lists of their own for the half of the word that an edit leaves alone: the first half of
    the shorter word of a pair, or what comes after it."""
    size = F.length("word")
    short = (size - F.col("long").cast("int")).cast("int")
    half = F.floor(short / 2).cast("int")
    halves = F.array(
        F.struct(F.lit(0).alias("side"), F.substring(F.col("word"), F.lit(1), half).alias("part")),
        F.struct(F.lit(1).alias("side"), F.substring(F.col("word"), size - (short - half) + 1, short - half).alias("part")),
    )
    met = postings.select("key", "long", "word", "n", F.inline(halves))
    return met.select(F.xxhash64("key", "side", "part").alias("key"), "long", "word", "n")


def _long_lists(postings: DataFrame, most: int) -> DataFrame:
    lists = postings.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    return stage(lists.where(F.col("c") > most).select("key"), "long-lists")


def near_pairs(
    words: DataFrame, frequent: int = FREQUENT, dictionary: int = DICTIONARY, long_list: int = LONG_LIST
) -> DataFrame:
    """`word, n, other, other_n`: pairs of distinct `words` (`word, n`; a stage table) exactly one edit apart, both ways round."""
    shortest = words.agg(F.min(F.length("word"))).first()[0]
    if shortest is not None and shortest + 2 < SHORTEST + LONGEST:
        raise ValueError(f"words of fewer than {SHORTEST + LONGEST - 2} characters need shorter grams")
    postings = stage(_postings(words, frequent_grams(words, frequent, dictionary)), "postings")
    lists = postings
    for divide in (_by_half, _without_one):
        longs = _long_lists(lists, long_list)
        if longs.isEmpty():
            break
        side = broadcast_if_small(longs)
        rest = lists.join(side, "key", "left_anti")
        lists = stage(rest.unionByName(divide(lists.join(side, "key", "left_semi"))), "lists")
    short = lists.where("not long").select("key", "word", "n")
    met = lists.select("key", "long", F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = short.join(met, "key").where("long or word < other").where(F.levenshtein("word", "other", 1) == 1)
    pairs = stage(pairs.select("word", "n", "other", "other_n").distinct(), "pairs")
    turned = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return pairs.unionByName(turned)


def _roots(forms: DataFrame) -> DataFrame:
    """`word, root`: the end of each chain of `word, form`. Every round doubles the steps taken; forms are ever more frequent."""
    reach = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if reach.join(step, "root", "left_semi").isEmpty():
            return reach
        reach = stage(reach.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")


def group_variants(words: DataFrame, times: int = 5, long_list: int = LONG_LIST, frequent: int = FREQUENT) -> DataFrame:
    """`word, form, root, n, n_near, form_n` for distinct `words` (`word, n`; a stage table).

    Words are near if exactly one inserted, deleted or replaced character tells them apart. The form of a word is its most
    frequent near word (ties: the smallest by code points) if that is at least `times` as frequent; `root` follows the forms
    to the last one. Words without a form are their own root. No words give no rows.
    """
    near = near_pairs(words, frequent=frequent, long_list=long_list)
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("w"))).alias("best")
    )
    found = words.join(best, "word", "left")
    fits = -F.col("best.m") >= times * F.col("n")
    formed = stage(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("best.w")).alias("form"), F.when(fits, -F.col("best.m")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`group_variants` of the `vocabulary` of whole texts. Null texts have no words, an empty table gives no rows,
    repeated rows count as often as they occur, and other columns don't matter."""
    return group_variants(stage(vocabulary(docs, doc_id, text), "vocabulary"))
