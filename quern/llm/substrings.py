"""Repeated substrings of a collection of texts, by column-wise construction of its Burrows-Wheeler transform."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_texts, raw_bytes
from quern.session import stage

#: Parts that fragments are divided into.
PARTS = 8
#: Different fragments that one collection may take from a group; larger groups are divided further.
KINDS_AT_ONCE = 256
#: Fragments that are compared at once. Groups stay whole, so there may be more by one group.
FRAGMENTS_AT_ONCE = 512
#: Window starts of a text that are hashed at once.
SEGMENT = 1 << 20
_END = 255  # no byte of UTF-8, so it can stand for the end of a text
_BASE, _MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
_WRAP = (1 << 64) - 1


class Anchors:
    """Fragments of a text: for every window the leftmost least digest of its grams is its anchor, and the windows of one
    anchor, which follow each other, are a fragment.

    A window's anchor depends on its own bytes alone, so equal windows, wherever they are, have equal anchors at equal
    distances, and only fragments of one anchor digest can share a window.
    """

    def __init__(self, length: int):
        self.length, self.gram = length, max(1, length // 4)
        # Fixed pseudo-random values for bytes, from a hash function.
        digests = b"".join(hashlib.sha256(bytes([b])).digest()[:8] for b in range(256))
        self.values = np.frombuffer(digests, dtype="<u8").astype(np.uint64)
        self.powers = self.inverses = np.zeros(0, dtype=np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            size = max(size, min(2 * len(self.powers), SEGMENT + self.length))
            steps = np.full(size, _BASE, dtype=np.uint64)
            back = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
            steps[0] = back[0] = 1
            self.powers, self.inverses = np.multiply.accumulate(steps), np.multiply.accumulate(back)

    def of(self, text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each segment of window starts: digest of the anchor, of the fragment, first and last start, anchor's place."""
        for start in range(0, len(text) - self.length + 1, SEGMENT):
            part = text[start : start + SEGMENT + self.length - 1]
            digests, first, last, place = self._segment(np.frombuffer(part, dtype=np.uint8))
            lead = (place - first).tolist()
            ends = (last + self.length).tolist()
            digest = xxhash.xxh3_64_intdigest
            prints = np.fromiter(
                (digest(part[a:b], c) for a, b, c in zip(first.tolist(), ends, lead, strict=True)), dtype=np.uint64, count=len(lead)
            )
            yield digests.view(np.int64), prints.view(np.int64), first + start, last + start, place + start

    def _segment(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
        grams = (sums[self.gram :] - sums[: -self.gram]) * self.inverses[: len(data) - self.gram + 1]
        grams ^= grams >> np.uint64(32)
        grams *= np.uint64(_MIX)
        grams ^= grams >> np.uint64(29)
        # The digest's upper bits, then the place: the least of a window is its leftmost least digest.
        low = np.uint64(2 * SEGMENT - 1)
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        width, have = self.length - self.gram + 1, 1
        while 2 * have <= width:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < width:
            least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
        place = (least & low).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        last = np.r_[first[1:], len(place)] - 1
        place = place[first]
        return grams[place], first, last, place


def column_wise(texts: list[bytes], most: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """`common, places` of a collection: `common[r]` is how many bytes (at most `most` < 256) the suffixes of ranks r - 1 and r
    have in common, and `places[i][t]` the rank of the last t bytes of text i.

    Every round inserts one symbol of each text that has one left, from its end: the suffixes that begin with the symbols
    inserted last find their ranks by counting equal symbols before them in the transform, and each one's common prefix
    with its neighbours is one more than the least between the places of two equal symbols. Transform and common prefixes
    are two sequences that every round reads and writes once from the start to the end. Ends of texts come last, in the
    order of the texts, and never match.
    """
    count = len(texts)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    longest = int(sizes.max(initial=0))
    column = np.full((longest + 1, count), _END, dtype=np.uint8)  # row t: the symbols before the last t bytes
    for i, text in enumerate(texts):
        column[: len(text), i] = np.frombuffer(text, dtype=np.uint8)[::-1]
    symbols, common = column[0].copy(), np.zeros(count, dtype=np.uint8)
    at = alive = np.arange(count)
    ended = int((sizes == 0).sum())
    for t in range(1, longest + 1):
        keep = sizes[alive] >= t
        alive, at = alive[keep], at[keep]
        turn = np.argsort(symbols, kind="stable")  # places by symbol: suffixes in order, but for those that are ends
        to = np.empty(len(turn), dtype=np.int32)
        to[turn] = np.arange(len(turn), dtype=np.int32)
        at = to[at].astype(np.int64)
        order = np.argsort(at)
        below, common = np.append(common, np.uint8(0)), np.insert(common, at[order] - np.arange(len(at)), 0)
        _neighbours(symbols, below, common, turn, at, len(symbols) - ended, most)
        symbols = np.insert(symbols, at[order] - np.arange(len(at)), column[t, alive[order]])
        ended += int((sizes[alive] == t).sum())
    turn = np.argsort(symbols, kind="stable")
    to = np.empty(len(turn), dtype=np.int64)
    to[turn] = np.arange(len(turn))
    ranks = np.zeros((longest + 1, count), dtype=np.int64)
    ranks[0] = len(symbols) - count + np.arange(count)
    for t in range(1, longest + 1):
        ranks[t] = to[ranks[t - 1]]
    return common, [ranks[: size + 1, i] for i, size in enumerate(sizes)]


def _neighbours(
    symbols: np.ndarray, below: np.ndarray, common: np.ndarray, turn: np.ndarray, rank: np.ndarray, ends: int, most: int
) -> None:
    """Put into `common` what new suffixes of ranks `rank`, and the suffixes after them, have in common with those before them.

    `symbols` and `below` are symbols and prefixes before the insertion, `turn` the places by symbol; from rank `ends` on there are ends of texts.
    What two suffixes with one symbol more have in common follows from what all between them without it had.
    """
    if ends < len(common):
        common[ends] = 0
    changed = np.concatenate([rank, rank + 1])
    changed = changed[changed < ends]
    here, before = turn[changed], turn[changed - 1]
    same = (changed > 0) & (symbols[here] == symbols[before])
    common[changed[~same]] = 0
    changed, here, before = changed[same], here[same], before[same]
    if len(here):
        order = np.argsort(here)
        bounds = np.stack([before[order], here[order]], axis=1).ravel() + 1
        least = np.minimum.reduceat(below, bounds)[::2]
        common[changed[order]] = np.minimum(least, np.uint8(most - 1)) + 1


def shared_windows(fragments: list[tuple[int, int, bytes]], length: int) -> list[np.ndarray]:
    """Which windows of each fragment another fragment of its group has at the same distance from the anchor.

    A fragment is `group, lead, bytes` with the anchor at byte `lead`; a window starts at each byte that `length` bytes follow.
    """
    common, ranks = column_wise([text for _, _, text in fragments], length)
    alike = np.cumsum(common < length)  # suffixes with `length` bytes in common
    rows = []
    for i, (_, lead, text) in enumerate(fragments):
        starts = np.arange(len(text) - length + 1)
        rows.append((alike[ranks[i][len(text) - starts]], np.full(len(starts), i), lead - starts))
    groups = np.unique([g for g, _, _ in fragments], return_inverse=True)[1]
    run, owner, ahead = (np.concatenate(x) for x in zip(*rows, strict=True))
    key = (run * (int(groups.max()) + 1) + groups[owner]) * length + ahead
    _, which, times = np.unique(key, return_inverse=True, return_counts=True)
    shared = times[which] > 1
    ends = np.cumsum([len(starts) for _, starts, _ in rows])
    return np.split(shared, ends[:-1])


def _spans(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of true values."""
    edges = np.flatnonzero(np.diff(np.r_[False, marked, False].astype(np.int8)))
    return edges[::2], edges[1::2] - 1


def _keyed(docs: DataFrame, text: str, *others) -> DataFrame:
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return docs.select(F.xxhash64(body).alias("key"), body.alias("body"), *others)


def _fragments(docs: DataFrame, text: str, length: int) -> DataFrame:
    """`key, anchor, print, times`: the different fragments of each text, by digests; `key` is a digest of the text."""
    names, types = ["key", "anchor", "print", "times"], [pa.int64(), pa.int64(), pa.int64(), pa.int32()]

    def cut(batches):
        anchors = Anchors(length)
        for batch in batches:
            out = []
            for key, body in zip(batch.column(0).to_pylist(), raw_bytes(batch.column(1)), strict=True):
                parts = [(a, p) for a, p, *_ in anchors.of(body)]
                if parts:
                    pairs = np.stack([np.concatenate(x) for x in zip(*parts, strict=True)], axis=1)
                    # Texts that repeat themselves have few different fragments, however long they are.
                    kinds, times = np.unique(pairs.view("i8,i8").ravel(), return_counts=True)
                    out.append((np.full(len(kinds), key), kinds["f0"], kinds["f1"], times.astype(np.int32)))
            columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    texts = _keyed(docs, text).where(F.octet_length("body") >= length)
    return map_texts(texts, cut, "key long, anchor long, print long, times int")


def _with_lists(texts: DataFrame, entries: DataFrame, fields: list[str], how: str) -> DataFrame:
    """`texts` with `wanted`, the `fields` that `entries`, a stage table, has for its key, once each."""
    lists = entries.groupBy("key").agg(F.collect_set(F.struct(*fields)).alias("wanted"))
    return texts.join(lists, "key", how)


def _lists_of(column: pa.Array) -> Iterator[list[tuple]]:
    """The rows of each list of a list column; null is empty."""
    fields = [c.to_pylist() for c in column.flatten().flatten()]
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy()).tolist()
    for a, b in zip([0, *ends], ends, strict=False):
        yield list(zip(*[f[a:b] for f in fields], strict=True))


def _bytes_of(docs: DataFrame, wanted: DataFrame, text: str, length: int) -> DataFrame:
    """`wanted` (`key, anchor, print, times, many`) with `lead, bytes` of each fragment; copies of a text may give one again."""
    names = ["anchor", "print", "times", "many", "lead", "bytes"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary()]

    def cut(batches):
        anchors, done = Anchors(length), set()
        for batch in batches:
            out = []
            for key, body, rows in zip(batch.column(0).to_pylist(), raw_bytes(batch.column(1)), _lists_of(batch.column(2)), strict=True):
                if key in done:  # a copy
                    continue
                done.add(key)
                left = {row[:2]: row for row in rows}
                for digests, prints, first, last, place in anchors.of(body):
                    pairs = zip(digests.tolist(), prints.tolist(), strict=True)
                    for pair, x, y, at in zip(pairs, first.tolist(), last.tolist(), place.tolist(), strict=True):
                        if pair in left:
                            out.append((*left.pop(pair), at - x, body[x : y + length]))
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    fields = ["anchor", "print", "times", "many"]
    texts = _with_lists(_keyed(docs, text), wanted, fields, "inner").select("key", "body", "wanted")
    return map_texts(texts, cut, "anchor long, print long, times long, many boolean, lead int, bytes binary")


def _parts(low: int, high: int) -> list[tuple[int, int]]:
    edges = [low + (high + 1 - low) * i // PARTS for i in range(PARTS + 1)]
    return [(a, b - 1) for a, b in zip(edges, edges[1:], strict=False) if a < b]


def compare(rows: list[tuple[int, int, int, bytes]], length: int) -> list[list[tuple[int, int]]]:
    """For each of `group, times, lead, bytes` the distances from its anchor, from and to, at which it shares windows.

    Within a group fragments are divided by distance; parts whose common bytes no other has are alone, and parts that are
    all alike are shared. What is left goes into one collection, each different part once.
    """
    groups: dict[int, list[int]] = {}
    for i, (group, *_) in enumerate(rows):
        groups.setdefault(group, []).append(i)
    spans: list[list[tuple[int, int]]] = [[] for _ in rows]
    collection: dict[tuple[int, int, bytes], list[int]] = {}
    number = 0
    for members in groups.values():
        low = min(rows[i][2] - len(rows[i][3]) + length for i in members)
        high = max(rows[i][2] for i in members)
        for a, b in _parts(low, high):
            met: dict[bytes, dict[tuple[int, bytes], list[int]]] = {}
            for i in members:
                _, _, lead, text = rows[i]
                first, last = max(lead - b, 0), min(lead - a, len(text) - length)
                if first <= last:
                    alike = met.setdefault(text[lead - a : lead - b + length], {})
                    alike.setdefault((lead - first, text[first : last + length]), []).append(i)
            for alike in met.values():
                if len(alike) > 1:
                    collection.update({(number, *part): owners for part, owners in alike.items()})
                    number += 1
                else:
                    ((lead, part), owners), = alike.items()
                    if len(owners) > 1:
                        for i in owners:
                            spans[i].append((lead - len(part) + length, lead))
    if collection:
        fragments = list(collection)
        for (_, lead, _), owners, windows in zip(fragments, collection.values(), shared_windows(fragments, length), strict=True):
            if len(owners) > 1:
                windows = np.ones_like(windows)
            for first, last in zip(*(x.tolist() for x in _spans(windows)), strict=True):
                for i in owners:
                    spans[i].append((lead - last, lead - first))
    for i, (_, times, lead, text) in enumerate(rows):
        if times > 1:
            spans[i] = [(lead - len(text) + length, lead)]
    return spans


def _compared(kinds: DataFrame, length: int) -> DataFrame:
    """`group, kind, low, high`: the distances from the anchor at which windows of the kinds of a group are shared.

    `kinds` has `group, kind, times, lead, bytes`, few kinds for each group, some perhaps repeated. Groups are dealt to
    tasks whole, and each task compares some of them after the other.
    """
    names, types = ["group", "kind", "low", "high"], [pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def search(rows: list[tuple]) -> pa.RecordBatch:
        found = compare([(group, *rest) for group, _, *rest in rows], length)
        out = [(*row[:2], *span) for row, spans in zip(rows, found, strict=True) for span in spans]
        columns = zip(*out, strict=True) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and row[:2] == held[-1][:2]:
                    continue
                if len(held) >= FRAGMENTS_AT_ONCE and row[0] != held[-1][0]:
                    yield search(held)
                    held = []
                held.append(row)
        if held:
            yield search(held)

    rows = kinds.select("group", "kind", "times", "lead", "bytes").repartition("group").sortWithinPartitions("group", "kind")
    return map_texts(rows, run, "group long, kind long, low int, high int")


def _divided(rows: DataFrame, length: int) -> DataFrame:
    """Fragments in `PARTS`, by their windows' distances from the anchor. The bytes that all windows of a part have in
    common, more than the anchor, divide a group into new ones."""

    def run(batches):
        for batch in batches:
            out = []
            for anchor, fingerprint, group, times, low, high, lead, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                for a, b in _parts(low, high):
                    # Windows start at byte lead - distance.
                    first, last = max(lead - b, 0), min(lead - a, len(text) - length)
                    if first <= last:
                        part = text[first : last + length]
                        core = text[lead - a : lead - b + length]
                        new = xxhash.xxh3_64_intdigest(core, (group ^ (a * 1024 + b)) & _WRAP)
                        kind = xxhash.xxh3_64_intdigest(part, lead - first)
                        out.append((anchor, fingerprint, _signed(new), _signed(kind), times, a, b, lead - first, part))
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _ROW_TYPES, strict=True)], names)

    names = [n.split()[0] for n in _ROWS.split(", ")]
    columns = rows.select("anchor", "print", "group", "times", "low", "high", "lead", "bytes")
    return map_texts(columns, run, _ROWS)


_ROWS = "anchor long, print long, group long, kind long, times long, low int, high int, lead int, bytes binary"
_ROW_TYPES = [pa.int64()] * 5 + [pa.int32()] * 3 + [pa.binary()]


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def _shared(docs: DataFrame, repeated: DataFrame, text: str, length: int) -> DataFrame:
    """`anchor, print, low, high`: the fragments of `repeated` (`key, anchor, print, times`; a stage table) that have shared
    windows, with the distances from their anchors at which those are.

    A fragment that is all there is to its anchor is shared as a whole. Few different fragments of an anchor are compared
    in one task. Where there are very many, they are divided by the distance of windows from the anchor, again and again
    while parts meet very many others, down to single windows.
    """
    kinds = stage(repeated.groupBy("anchor", "print").agg(F.sum("times").alias("times"), F.min("key").alias("key")), "kinds")
    several = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("different"))
    placed = stage(kinds.join(several, "anchor"), "placed")
    span = (F.lit(0).alias("low"), F.lit(length - max(1, length // 4)).alias("high"))
    shared = placed.where("different = 1").select("anchor", "print", *span)
    many = (F.col("different") > KINDS_AT_ONCE).alias("many")
    wanted = stage(placed.where("different > 1").select("key", "anchor", "print", "times", many), "wanted")
    if wanted.isEmpty():
        return shared
    found = stage(_bytes_of(docs, wanted, text, length), "bytes")
    few = found.where("not many").withColumnsRenamed({"anchor": "group", "print": "kind"})
    shared = shared.unionByName(_compared(few, length).withColumnsRenamed({"group": "anchor", "kind": "print"}))
    rows = found.where("many")
    if rows.isEmpty():
        return shared
    once = rows.dropDuplicates(["anchor", "print"])
    rows = once.select("anchor", "print", F.col("anchor").alias("group"), F.col("print").alias("kind"), "times", *span, "lead", "bytes")
    while not rows.isEmpty():
        rows = stage(_divided(rows, length), "parts")
        alike = rows.groupBy("group", "kind").agg(F.sum("times").alias("all"))
        groups = alike.groupBy("group").agg(F.sum("all").alias("total"), F.count(F.lit(1)).alias("different"))
        met = stage(rows.join(groups.where("total > 1"), "group"), "met")
        shared = shared.unionByName(met.where("different = 1").select("anchor", "print", "low", "high"))
        few = met.where(F.col("different").between(2, KINDS_AT_ONCE))
        each = few.groupBy("group", "kind").agg(F.sum("times").alias("times"), F.first(F.struct("lead", "bytes")).alias("f"))
        ranges = stage(_compared(each.select("group", "kind", "times", "f.*"), length), "ranges")
        shared = shared.unionByName(few.drop("low", "high").join(ranges, ["group", "kind"]).select("anchor", "print", "low", "high"))
        rows = met.where(F.col("different") > KINDS_AT_ONCE).drop("total", "different")
    return shared


def remove_repeats(docs: DataFrame, length: int = 200, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`: every text without the bytes that a repeated string covers.

    A string of `length` bytes (at most 255) is repeated if it also starts elsewhere, in the same text or another;
    overlaps count, and strings never cross texts. `kept` has the remaining bytes. Null texts are empty, rows that repeat
    repeat each other's strings, an empty table gives no rows, ids may repeat or be null, and other columns don't matter.

    Texts are cut into fragments of fewer than two `length`s by anchors that equal strings share, and fragments meet by
    digests of anchors and of themselves (64 bits each). Equal ones become one with a number before anything is compared,
    so copies cost a digest each. Only different fragments of one anchor are compared, by bytes, in collections of bounded
    size (`column_wise`). Then each text gets the list of its shared fragments back.
    """
    if not 4 <= length < 256:
        raise ValueError("windows are 4 to 255 bytes long")
    found = stage(_fragments(docs, text, length), "fragments")
    again = found.groupBy("anchor").agg(F.sum("times").alias("total")).where("total > 1").select("anchor")
    repeated = stage(found.join(again, "anchor"), "repeated")
    shared = _shared(docs, repeated, text, length)
    # A text's own fragments are told apart by one number; where they are shared is two bytes.
    met = repeated.select("key", "anchor", "print").join(shared.distinct(), ["anchor", "print"])
    one, span = F.col("anchor").bitwiseXOR(F.col("print")), F.col("low") * 256 + F.col("high")
    entries = stage(met.select("key", one.alias("id"), span.cast("int").alias("span")), "entries")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    types = [pa.int64()] * 4 + [pa.string(), pa.binary()]

    def strike(batches):
        anchors = Anchors(length)
        for batch in batches:
            out = []
            for key, body, rows in zip(batch.column(0).to_pylist(), raw_bytes(batch.column(1)), _lists_of(batch.column(2)), strict=True):
                ranges: dict[int, list[tuple[int, int]]] = {}
                for one, span in rows:
                    ranges.setdefault(one, []).append(divmod(span, 256))
                edges = np.zeros(len(body) + 1, dtype=np.int32)
                for digests, prints, first, last, place in anchors.of(body) if ranges else ():
                    for one, x, y, at in zip((digests ^ prints).tolist(), first.tolist(), last.tolist(), place.tolist(), strict=True):
                        for low, high in ranges.get(one, ()):
                            start, end = max(x, at - high), min(y, at - low) + length
                            if end - start >= length:
                                edges[start] += 1
                                edges[end] -= 1
                gone = np.cumsum(edges)[:-1] > 0
                kept = np.frombuffer(body, dtype=np.uint8)[~gone].tobytes() if gone.any() else body
                out.append((key, len(body), len(body) - len(kept), len(_spans(gone)[0]), hashlib.sha256(kept).hexdigest(), kept))
            rows = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(rows, types, strict=True)], names)

    texts = _keyed(docs, text, F.col(doc_id).cast("long").alias("doc_id"))
    listed = _with_lists(texts, entries, ["id", "span"], "left").select("doc_id", "body", "wanted")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return map_texts(listed, strike, schema)
