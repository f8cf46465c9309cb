"""Best-two-fit packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_texts, numbered, ranked, raw_bytes
from quern.session import stage

#: Words whose ids a worker keeps; when there are more, only those of the texts at hand stay. Longer words are not kept.
CACHED_WORDS = 400_000
CACHED_BYTES = 64
#: Words that are tokenised as one text.
WORDS_AT_ONCE = 256

_STOP = r"([a-zß-öø-ÿ])([.,]\s)"

_WORKER: dict[str, WordIds] = {}


class WordIds:
    """Ids of white-space separated words by a tokenizer that drops white space.

    Such a tokenizer never joins letters across white space, so a word has the same ids in any text.
    Frequent words are kept; words not kept are tokenised again.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        suffix = model["end_of_word_suffix"]
        if not suffix:
            raise ValueError("the tokenizer must mark the ends of words")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[[i for token, i in model["vocab"].items() if token.endswith(suffix)]] = True
        # A special token between words keeps them apart like texts of their own.
        added = self.tokenizer.get_added_tokens_decoder()
        self.mark, self.marker = next(((i, t.content) for i, t in sorted(added.items()) if t.special), (None, ""))
        self.known = pa.array([], pa.large_string())
        self.ids, self.lengths = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)

    def _learned(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of `words`, their ids in that order, one word after the other, and how many ids each has."""
        alpha = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
        plain, other = np.flatnonzero(alpha), np.flatnonzero(~alpha)
        parts = []
        for group, between, ends_of, gap in (
            (plain, " ", lambda ids: np.flatnonzero(self.ends[ids]) + 1, 0),
            (other, self.marker, lambda ids: np.append(np.flatnonzero(ids == self.mark), len(ids)), 1),
        ):
            strings = words.take(pa.array(group)).to_pylist()
            for start in range(0, len(strings), WORDS_AT_ONCE):
                parts.append(self._joined(strings[start : start + WORDS_AT_ONCE], between, ends_of, gap))
        ids, lengths = zip(*parts, strict=True) if parts else ([self.ids[:0]], [self.lengths[:0]])
        return np.r_[plain, other], np.concatenate(ids), np.concatenate(lengths)

    def _joined(self, words: list[str], between: str, ends_of, gap: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and numbers of ids of words tokenised as one text. `ends_of` finds where each ends in the ids, the next
        starting `gap` ids later; words that are not one piece each, as both ways of joining expect, are tokenised one by one."""
        if between:
            ids = np.array(self._encode([between.join(words)])[0], dtype="<u4")
            ends = ends_of(ids)
            if len(ends) == len(words):
                lengths = np.diff(ends, prepend=-gap) - gap
                return (ids[ids != self.mark] if gap else ids), lengths
        each = self._encode(words)
        return np.concatenate([np.asarray(x, dtype="<u4") for x in each]), np.array([len(x) for x in each], dtype=np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def of(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text. Words are split, told apart and looked up by Arrow, each distinct one once."""
        column = pa.array([t.decode("utf-8", "replace") for t in texts], pa.large_string())
        # The tokenizer lower-cases; doing it first keeps fewer words, but would make special tokens.
        column = pc.if_else(pc.match_substring(column, "<|"), column, pc.ascii_lower(column))
        # A full stop or comma after a word is a piece of its own anyway; split off, it leaves fewer words to know.
        column = pc.replace_substring_regex(column, pattern=_STOP, replacement=r"\1 \2")
        split = pc.ascii_split_whitespace(column)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary
        place = pc.index_in(words, value_set=self.known)
        ids, lengths = self.ids, self.lengths
        if place.null_count:
            missing = np.flatnonzero(pc.is_null(place).to_numpy(zero_copy_only=False))
            place = pc.fill_null(place, 0).to_numpy().copy()
            order, new_ids, new_lengths = self._learned(words.take(pa.array(missing)))
            place[missing[order]] = len(self.known) + np.arange(len(missing))
            ids, lengths = np.r_[ids, new_ids], np.r_[lengths, new_lengths]
            self._keep(pa.concat_arrays([self.known, words.take(pa.array(missing[order]))]), ids, lengths, place)
        else:
            place = place.to_numpy(zero_copy_only=False)
        starts = np.cumsum(lengths) - lengths
        codes = place[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = lengths[codes]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[codes] - (ends - sizes), sizes)
        return np.split(ids[at], np.r_[0, ends][split.offsets.to_numpy()[1:-1]])

    def _keep(self, known: pa.Array, ids: np.ndarray, lengths: np.ndarray, used: np.ndarray) -> None:
        """Keep words and their ids for the next texts: all, or those `used` just now when there are too many."""
        kept = pc.binary_length(known).to_numpy() <= CACHED_BYTES
        if kept.sum() > CACHED_WORDS:
            now = np.zeros(len(known), dtype=bool)
            now[used[:CACHED_WORDS]] = True
            kept &= now
        self.known, self.ids, self.lengths = known.filter(pa.array(kept)), ids[np.repeat(kept, lengths)], lengths[kept]


def _word_ids(path: str) -> WordIds:
    if path not in _WORKER:
        _WORKER[path] = WordIds(path)
    return _WORKER[path]


def tokenise(docs: DataFrame, path: str, room: int, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32, row`: the pieces of every document, one row each.

    A document is its ids and then `end_id`; one of more than `room` ids is cut into pieces of `room`.
    A null text counts as empty. `row` numbers the rows of `docs`, so that repeated ids stay apart.
    """

    def cut(batches):
        words = _word_ids(path)
        for batch, rows in numbered(batches):
            out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": [], "row": []}
            keys = batch.column(0).to_pylist()
            for key, row, ids in zip(keys, rows, words.of(raw_bytes(batch.column(1))), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), room)):
                    part = ids[start : start + room]
                    for name, value in zip(out, (key, piece, start, len(part), zlib.crc32(part.tobytes()), row), strict=True):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))

    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"
    return map_texts(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), cut, schema)


def best_two_fit(counts: dict[int, int], room: int) -> list[tuple[list[int], int]]:
    """Bins as `(lengths in the bin, number of such bins)`, for so many pieces of each length.

    A bin takes the longest piece left and then, as often as one fits, the longest that fits. Then
    its shortest piece is replaced by the two pieces left that fill the gap it leaves more tightly.
    One bin after the other would repeat itself until a length runs out, so a bin is made as often as
    the pieces left allow; there are a few bins for each length, however many pieces there are.
    """
    left = np.zeros(room + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    bins = []
    while left.any():
        below = np.maximum.accumulate(np.where(left > 0, np.arange(room + 1), 0))  # longest left, at most so long
        taken = np.zeros(room + 1, dtype=np.int64)
        gap = room
        while gap and (length := _longest(left, taken, below, gap)):
            taken[length] += 1
            gap -= length
        if gap:
            gap = _swap(left, taken, gap)
        used = np.flatnonzero(taken)
        times = int((left[used] // taken[used]).min())
        left[used] -= times * taken[used]
        bins.append((np.repeat(used, taken[used])[::-1].tolist(), times))
    return bins


def _longest(left: np.ndarray, taken: np.ndarray, below: np.ndarray, gap: int) -> int:
    length = int(below[gap])
    while length and left[length] == taken[length]:
        length = int(below[length - 1])
    return length


def _swap(left: np.ndarray, taken: np.ndarray, gap: int) -> int:
    """Replace the shortest piece by two that fill more; returns the gap that stays."""
    shortest = int(np.flatnonzero(taken)[0])
    wider = gap + shortest
    free = left - taken
    lengths = np.arange(wider + 1)
    below = np.maximum.accumulate(np.where(free[: wider + 1] > 0, lengths, 0))
    first = np.flatnonzero(free[: wider + 1] > 0)
    second = below[wider - first]
    single = (second == first) & (free[first] < 2)
    second = np.where(single, np.where(first > 0, below[np.maximum(first - 1, 0)], 0), second)
    total = np.where(second > 0, first + second, 0)
    if not len(total) or total.max() <= shortest:
        return gap
    best = int(total.argmax())
    taken[shortest] -= 1
    taken[first[best]] += 1
    taken[second[best]] += 1
    return wider - int(total[best])


def pack(
    docs: DataFrame, path: str, room: int = 4096, end_id: int = 1, doc_id: str = "doc_id", text: str = "text", seed: int = 7
) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32, sequence_id, offset`: where each piece of each document goes.

    Documents are tokenised once, into a stage table without texts or ids. What decides the packing is
    the number of pieces of each length, at most `room` numbers, and so are the bins (a few for each length)
    that the driver makes of them. A piece finds its place by its rank among the pieces of its length.
    Empty and null texts are the end id alone; repeated rows are packed as often as they occur; an empty
    table gives no rows. Other columns of `docs` are not read. Sequences have no gaps.
    """
    pieces = stage(tokenise(docs, path, room, end_id, doc_id, text), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # For each length: ranks from `rank` on are dealt `each` at a time to sequences from `sequence` on.
    next_rank = dict.fromkeys(counts, 0)
    sequence, runs = 0, []
    for lengths, times in best_two_fit(counts, room):
        offset = 0
        places: dict[int, list[int]] = {}
        for length in lengths:
            places.setdefault(length, []).append(offset)
            offset += length
        for length, offsets in places.items():
            runs.append((length, next_rank[length], sequence, offsets))
            next_rank[length] += times * len(offsets)
        sequence += times
    runs.sort()
    shift = 2**40  # more than the pieces of one length
    starts = np.array([length * shift + rank for length, rank, _, _ in runs], dtype=np.int64)
    first = np.array([s for _, _, s, _ in runs], dtype=np.int64)
    each = np.array([len(o) for _, _, _, o in runs], dtype=np.int64)
    at = np.cumsum(each) - each
    offsets = np.array([x for *_, o in runs for x in o], dtype=np.int64)

    def place(batches):
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            key = columns["length"].to_numpy() * shift + columns.pop("rank").to_numpy()
            run = np.searchsorted(starts, key, side="right") - 1
            rank = key - starts[run]
            columns["sequence_id"] = pa.array(first[run] + rank // each[run])
            columns["offset"] = pa.array(offsets[at[run] + rank % each[run]])
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    rows = ranked(pieces, ["length"], seed, ["doc_id", "piece", "row"]).drop("row")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, rank long, sequence_id long, offset long"
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, schema.replace("rank long, ", "")
    )
