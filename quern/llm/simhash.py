"""SimHash near-duplicates: fingerprints within a few bits, found by a self-join of binary tries."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import fresh, map_texts, raw_bytes
from quern.session import broadcast_if_small, stage

BITS = 64
#: Node pairs that a task holds at once, and fingerprints that it searches at once.
FRONTIER = 1 << 20
FINGERPRINTS_AT_ONCE = 1 << 17
#: Shingle hashes that a task adds up at once.
HASHES_AT_ONCE = 1 << 19


def majority(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For runs of `counts` values each: the bits that more than half of a run's values have."""
    # Eight bits at a time lie in the eight bytes of a sum, which hold up to 255 values each.
    runs = -(-counts // 255)
    first_run = np.cumsum(runs) - runs
    starts = np.repeat(np.cumsum(counts) - counts, runs) + 255 * (np.arange(runs.sum()) - np.repeat(first_run, runs))
    ones = np.zeros((len(counts), BITS), dtype=np.int64)
    for shift in range(8):
        low = values >> np.uint64(shift) & np.uint64(0x0101010101010101)
        sums = np.add.reduceat(low, starts).astype("<u8").view(np.uint8).reshape(-1, 8)
        ones[:, shift::8] = np.add.reduceat(sums, first_run, axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > counts[:, None], axis=1, bitorder="little")
    return bits.reshape(-1, 8).copy().view("<u8").ravel().astype(np.uint64)


def fingerprints_of(texts: list[bytes], words: int, seed: int) -> np.ndarray:
    """64-bit SimHash of each text over shingles of `words` words, repeats included."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), dtype=np.uint64)
    first = 0

    def add_up(last: int) -> None:
        """Fingerprints of the texts from `first` to `last`."""
        if hashes:
            some = np.flatnonzero(counts[first:last]) + first
            out[some] = majority(np.array(hashes, dtype=np.uint64), counts[some])

    for i, text in enumerate(texts):
        tokens = text.lower().split()
        if not tokens:
            continue
        shingles = (
            map(b" ".join, zip(*(tokens[k:] for k in range(words)), strict=False)) if len(tokens) >= words else [b" ".join(tokens)]
        )
        before = len(hashes)
        hashes.extend([digest(s, seed) for s in shingles])
        counts[i] = len(hashes) - before
        if len(hashes) >= HASHES_AT_ONCE:
            add_up(i + 1)
            hashes, first = [], i + 1
    add_up(len(texts))
    return out


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, fp`: the fingerprint of every whole text as a long. Texts without words (and null) have 0."""

    def hashed(batches):
        for batch in batches:
            found = fingerprints_of(raw_bytes(batch.column(1)), words, seed)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_texts(rows, hashed, "doc_id long, fp long")


class _Sets:
    """Disjoint sets of numbered fingerprints; the smallest number stands for a set."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            self.flatten()
            a, b = self.parent[a], self.parent[b]
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))

    def flatten(self) -> None:
        while (up := self.parent[self.parent]).tobytes() != self.parent.tobytes():
            self.parent = up


def trie_components(keys: np.ndarray, fps: np.ndarray, errors: int) -> np.ndarray:
    """For fingerprints sorted by key and value: the first position of each one's set within its key.

    The fingerprints of a key are the leaves of a binary trie; a node is a range of positions. Pairs of
    nodes go down together from (root, root) of every key. Children that differ cost an error, and a pair
    whose errors exceed the budget goes no further. Neither does a pair whose leaves are all in one set
    already, nor one whose differences cannot exceed the budget any more: its leaves are joined at once.
    """
    n = len(fps)
    sets = _Sets(n)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if n else np.zeros(0, dtype=np.int64)
    ends = np.r_[starts[1:], n]
    roots = ends - starts > 1
    zero = np.zeros(int(roots.sum()), dtype=np.int64)
    work = [(BITS, starts[roots], ends[roots], starts[roots], ends[roots], zero)]
    zeros_before: dict[int, np.ndarray] = {}
    while work:
        depth, a0, a1, b0, b1, err = work.pop()
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            work.append((depth, *(x[half:] for x in (a0, a1, b0, b1, err))))
            work.append((depth, *(x[:half] for x in (a0, a1, b0, b1, err))))
            continue
        sets.flatten()
        label = sets.parent
        breaks = np.r_[0, np.cumsum(label[1:] != label[:-1])]
        one_set = (label[a0] == label[b0]) & (breaks[a1 - 1] == breaks[a0]) & (breaks[b1 - 1] == breaks[b0])
        leaves = (a1 - a0 == 1) & (b1 - b0 == 1)
        near = leaves & ~one_set
        near[near] = np.bitwise_count(fps[a0[near]] ^ fps[b0[near]]) <= errors
        sets.join(a0[near], b0[near])
        whole = ~leaves & ~one_set & (err + depth <= errors)
        for at in np.flatnonzero(whole):
            members = np.r_[a0[at] : a1[at], b0[at] : b1[at]]
            sets.join(members, np.full(len(members), members[0]))
        go = ~leaves & ~one_set & ~whole
        if depth == 0 or not go.any():
            continue
        a0, a1, b0, b1, err = (x[go] for x in (a0, a1, b0, b1, err))
        if depth not in zeros_before:
            bit = fps >> np.uint64(depth - 1) & np.uint64(1)
            zeros_before[depth] = np.r_[0, np.cumsum(bit == 0)].astype(np.int32)
        zeros = zeros_before[depth]  # within a node zeros come first
        a_mid, b_mid = a0 + zeros[a1] - zeros[a0], b0 + zeros[b1] - zeros[b0]
        same = a0 == b0

        def pairs(p0, p1, q0, q1, cost, which):
            keep = (p1 > p0) & (q1 > q0) & which & (err + cost <= errors)
            keep &= (p0 != q0) | (p1 - p0 > 1)  # a leaf with itself
            return tuple(x[keep] for x in (p0, p1, q0, q1, err + cost))

        every = np.ones(len(a0), dtype=bool)
        equal = [pairs(a0, a_mid, b0, b_mid, 0, every), pairs(a_mid, a1, b_mid, b1, 0, every)]
        cross = [pairs(a0, a_mid, b_mid, b1, 1, every), pairs(a_mid, a1, b0, b_mid, 1, ~same)]
        # Of many pairs the last go on first, so that near leaves are joined before far ones are met.
        for kind in (cross, equal) if len(a0) > FRONTIER // 64 else (cross + equal,):
            both = [np.concatenate(x) for x in zip(*kind, strict=True)]
            if len(both[0]):
                work.append((depth - 1, *both))
    sets.flatten()
    return sets.parent


def _blocks(distinct: int, errors: int) -> int:
    """Number of blocks that the bits are cut into, so that a key is shared by few unrelated fingerprints."""
    for blocks in range(errors + 1, 2 * errors + 1):
        if distinct >> BITS * (blocks - errors) // blocks <= 32:
            break
    return blocks


def near_edges(distinct: DataFrame, errors: int, blocks: int) -> DataFrame:
    """`a, b`: links that join all of `fp` within `errors` bits, as a forest for each key and no more.

    Two fingerprints that differ in at most `errors` bits agree in all but `errors` of the blocks, so they
    meet under one of the keys made of the others. The tries of different keys are joined in parallel.
    """
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [
        sum(((1 << edges[i + 1]) - (1 << edges[i])) for i in chosen) for chosen in combinations(range(blocks), blocks - errors)
    ]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    keys = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("kind", "masked")
    keyed = distinct.select("fp", keys).select(F.xxhash64("kind", "masked").alias("key"), "fp")

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_fp = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def search(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            order = np.lexsort((fps.view(np.uint64), keys))
            keys, fps = keys[order], fps[order]
            root = trie_components(keys, fps.view(np.uint64), errors)
            linked = np.flatnonzero(root != np.arange(len(fps)))
            return pa.RecordBatch.from_arrays([pa.array(fps[root[linked]]), pa.array(fps[linked])], ["a", "b"])

        for batch in batches:
            held_key = np.r_[held_key, batch.column(0).to_numpy()]
            held_fp = np.r_[held_fp, batch.column(1).to_numpy()]
            if len(held_key) >= FINGERPRINTS_AT_ONCE:
                whole = int(np.searchsorted(held_key, held_key[-1]))  # the last key may go on
                if whole:
                    yield search(held_key[:whole], held_fp[:whole])
                    held_key, held_fp = held_key[whole:], held_fp[whole:]
        yield search(held_key, held_fp)

    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(forest, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """`node, root`: the smallest node of each one's component, by alternating large and small stars.

    Every round is two joins; nodes move to the smallest neighbour, so that stars are left in a number of
    rounds that grows with the logarithm of the longest path. Results of rounds are written tables.
    """
    edges = stage(edges.distinct(), "edges")
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, F.col("b") > F.col("a"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
        small = _star(down, F.lit(True))
        own = down.groupBy("a").agg(F.min("b").alias("b"))
        after = stage(small.where("a <> b").unionByName(own).distinct(), "edges")
        # Stars are reached when no node has two neighbours below it and none is both a root and a member.
        split = after.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        chained = after.join(after.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        if split.isEmpty() and chained.isEmpty():
            return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = after


def _star(edges: DataFrame, which: Column) -> DataFrame:
    """Each neighbour `b` of a node that `which` picks, linked to the smallest of the node and its neighbours."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return edges.where(which).join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def near_duplicates(
    docs: DataFrame, words: int = 4, errors: int = 4, seed: int = 42, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`doc_id, fingerprint, component_id, group`: one row per document, with the smallest id it is linked to.

    Fingerprints link when they differ in at most `errors` bits. Equal fingerprints become one before the
    search, so copies of a text cost one row however many there are. Null and empty texts have the
    fingerprint 0 and are linked like others. A null id is never the smallest; a component of null ids
    alone has a null id. Rows that repeat stay; an empty table gives no rows.
    """
    hashed = stage(fingerprints(docs, words, seed, doc_id, text), "fingerprints")
    return linked(hashed, errors)


def linked(hashed: DataFrame, errors: int) -> DataFrame:
    """`doc_id, fingerprint, component_id, group` for a stage table of `doc_id, fp`; `group` is a fingerprint of the component."""
    distinct = stage(hashed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    blocks = _blocks(max(1, distinct.count()), errors)
    member = components(near_edges(distinct.select("fp"), errors, blocks))
    rooted = distinct.join(member.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(least, "root")
    return hashed.join(by_fp, "fp").select(
        "doc_id", _hex("fp").alias("fingerprint"), "component_id", _hex("root").alias("group")
    )


def _hex(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_first(docs: DataFrame, words: int = 4, errors: int = 4, seed: int = 42, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` without near-duplicates: of each group the document with the smallest id stays, whole.

    Only ids and fingerprints are shuffled; what goes is broadcast when its measured size allows it. Of rows that
    repeat one id in a group, one stays; of a group of null ids alone, too.
    """
    hashed = stage(fingerprints(docs, words, seed, doc_id, text), "fingerprints")
    found = stage(linked(hashed, errors).withColumn("own", F.conv("fingerprint", 16, -10).cast("long")), "groups")
    return keep_rows(docs, found, lambda texts: fingerprints_of(texts, words, seed), doc_id, text)


def keep_rows(docs: DataFrame, found: DataFrame, own_of, doc_id: str, text: str) -> DataFrame:
    """The rows of `docs` that `found`, a stage table of `doc_id, own, component_id, group`, has first in their groups.

    `own_of` gives the value `own` of texts.
    """
    again = F.count(F.lit(1)) > 1
    repeated = stage(found.groupBy("doc_id").agg(again.alias("again")).where("again or doc_id is null").select("doc_id"), "repeated")
    removed = found.where("doc_id <> component_id or (doc_id is null and component_id is not null)")
    if repeated.isEmpty():
        key = fresh(docs, "_gone")
        gone = removed.select(F.col("doc_id").alias(key))
        return docs.join(broadcast_if_small(gone), docs[doc_id] == F.col(key), "left_anti")
    # Rows are told apart by id and `own`.
    names = docs.columns
    fp, key, kept_fp, group = (fresh(docs, n) for n in ("_fp", "_id", "_kept", "_group"))

    def with_key(batches):
        for batch in batches:
            fps = own_of(raw_bytes(batch.column(batch.schema.names.index(text))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))], [*batch.schema.names, fp])

    keyed = map_texts(docs, with_key, T.StructType([*docs.schema.fields, T.StructField(fp, T.LongType())]))
    kept = found.where("doc_id <=> component_id").select(
        F.col("doc_id").alias(key), F.col("own").alias(kept_fp), F.col("group").alias(group)
    ).distinct()
    on = keyed[doc_id].cast("long").eqNullSafe(kept[key]) & (keyed[fp] == kept[kept_fp])
    return keyed.join(kept, on).dropDuplicates([key, group]).select(*[keyed[n] for n in names])
