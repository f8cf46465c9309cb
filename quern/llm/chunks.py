"""Document fingerprints: digests of content-defined chunks, compared by weighted containment."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_texts

#: Least, normal and most bytes of a chunk.
LEAST, NORMAL, MOST = 16, 48, 192
#: A position ends a chunk when so many high bits of its hash are 0: before the normal size, and after it.
STRICT_BITS, LOOSE_BITS = 7, 4
#: Bytes that are hashed at once.
BYTES_AT_ONCE = 1 << 21
#: Rows per block of the document order, and the most blocks.
ROWS_PER_BLOCK, MOST_BLOCKS = 2048, 65_536

_WINDOW = 32
_PAD = 255  # occurs in no UTF-8 text; its gear is 0
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 1) for b in range(255)] + [0], dtype=np.uint32)


def chunk_ends(texts: list[bytes]) -> Iterator[list[int]]:
    """For each text the ends of its chunks.

    The gear hash of a position depends on the 32 bytes up to it, so an edit moves boundaries near it only.
    Normalised chunking: boundaries are rare before the normal size and frequent after it.
    """
    pad = bytes([_PAD]) * _WINDOW
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= BYTES_AT_ONCE):
            size += len(texts[last]) + _WINDOW
            last += 1
        data = np.frombuffer(pad.join(texts[first:last]), dtype=np.uint8)
        hashes = _GEAR[data]
        for shift in (1, 2, 4, 8, 16):  # sums over 2, 4, ... 32 bytes
            hashes[shift:] += hashes[:-shift] << np.uint32(shift)
        loose = np.flatnonzero(hashes >> np.uint32(32 - LOOSE_BITS) == 0)
        strict = loose[hashes[loose] >> np.uint32(32 - STRICT_BITS) == 0].tolist()
        loose = loose.tolist()
        at = 0
        for text in texts[first:last]:
            yield _cut(at, len(text), strict, loose)
            at += len(text) + _WINDOW
        first = last


def _cut(at: int, size: int, strict: list[int], loose: list[int]) -> list[int]:
    ends, start, stop = [], at, at + size
    while start < stop:
        end = start + MOST
        i = bisect_left(strict, start + LEAST - 1)
        if i < len(strict) and strict[i] < start + NORMAL - 1:
            end = strict[i] + 1
        else:
            i = bisect_left(loose, start + NORMAL - 1)
            if i < len(loose) and loose[i] < end - 1:
                end = loose[i] + 1
        start = min(end, stop)
        ends.append(start - at)
    return ends


def chunk_sets(texts: list[bytes]) -> list[dict[int, int]]:
    """For each text its chunk digests with the chunks' lengths in bytes."""
    digest = xxhash.xxh64_intdigest
    found = []
    for text, ends in zip(texts, chunk_ends(texts), strict=True):
        chunks, start = {}, 0
        for end in ends:
            chunks[digest(text[start:end])] = end - start
            start = end
        found.append(chunks)
    return found


def containment(one: dict[int, int], other: dict[int, int]) -> float:
    """The share of one set's bytes whose chunks are in the other; two empty sets are alike."""
    if not one:
        return 0.0 if other else 1.0
    return sum(one[d] for d in one.keys() & other.keys()) / sum(one.values())


def fingerprint(chunks: dict[int, int]) -> str:
    """The set as text: `digest:length`, in order of the digests."""
    return ",".join([f"{d:016x}:{n}" for d, n in sorted(chunks.items())])


def parse_fingerprint(text: str) -> dict[int, int]:
    return {int(d, 16): int(n) for d, _, n in (x.partition(":") for x in text.split(","))} if text else {}


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, fingerprint`: the chunk set of every whole text. Null and empty texts have none: ''."""

    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            prints = [fingerprint(c) for c in chunk_sets(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_texts(rows, run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as many characters from the start of the following one."""
    moved = len(text) // 3
    return text[: len(text) - moved] + following[:moved]


def _with_next(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """`doc_id, text, block, extra`, dealt by block and in descending order of ids inside it.

    Every block ends with an `extra` row: the first document of the next block, and of the first block at the
    very end. Only ids are read to place the blocks, and every text moves once.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63)).cast("long")).alias("place"),
    )
    places = rows.select("place")
    blocks = max(1, min(MOST_BLOCKS, -(-places.count() // ROWS_PER_BLOCK)))
    shares = F.array(*[F.lit((i + 1) / blocks) for i in range(blocks - 1)]) if blocks > 1 else F.array(F.lit(0.0))
    bounds = np.unique(np.array(places.agg(F.percentile_approx("place", shares, 10 * blocks + 10_000)).first()[0] or [], dtype=np.int64))

    @F.pandas_udf("int")
    def block_of(place: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(bounds, place.to_numpy(), side="right"), dtype="int32")

    heads = sorted(tuple(r) for r in places.groupBy(block_of("place").alias("block")).agg(F.max("place").alias("place")).collect())
    # The first id of a block goes to the block before it as well; blocks without rows are passed over.
    also = {place: heads[i - 1][0] for i, (_, place) in enumerate(heads)}
    first_ids = np.array(sorted(also), dtype=np.int64)
    to = np.array([also[p] for p in first_ids.tolist()], dtype=np.int32)

    @F.pandas_udf("array<int>")
    def blocks_of(place: pd.Series) -> pd.Series:
        values = place.to_numpy()
        own = (len(bounds) - np.searchsorted(bounds, values, side="right")).astype(np.int32)
        at = np.minimum(np.searchsorted(first_ids, values), len(first_ids) - 1)
        head = first_ids[at] == values
        return pd.Series([[b, t] if h else [b] for b, t, h in zip(own.tolist(), to[at].tolist(), head.tolist(), strict=True)])

    return (
        rows.select("doc_id", "text", "place", F.posexplode(blocks_of("place")).alias("extra", "block"))
        .repartition("block")
        .sortWithinPartitions("block", "extra", F.desc("place"), "text")
        .select("doc_id", "text", "block", "extra")
    )


def compare_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`.

    Every document is compared with its edited text (see `edited`) and with the next document, in descending
    order of ids; the first follows the last. Null ids come last, equal ids in order of their texts. Null texts
    are empty; two empty texts are alike (1), an empty and another are not (0). A single document follows itself.
    Rows that repeat are compared each; an empty table gives no rows.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def compared(rows: list[tuple]) -> pa.RecordBatch:
        """Rows of a block and the one after them; a row whose follower is of another block is an extra one."""
        sets = chunk_sets([r[1].encode() for r in rows])
        pairs = [i for i in range(len(rows) - 1) if not rows[i][3]]
        texts = [edited(rows[i][1], rows[i + 1][1]) for i in pairs]
        raw = [t.encode() for t in texts]
        found = chunk_sets(raw)
        out: list[tuple] = []
        for i, data, after in zip(pairs, raw, found, strict=True):
            mine = sets[i]
            out.append((
                rows[i][0], len(rows[i][1]), hashlib.sha256(data).hexdigest(), fingerprint(mine), fingerprint(after),
                containment(mine, after), containment(mine, sets[i + 1]),
            ))
        columns = zip(*out, strict=True) if out else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    def run(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                size += len(row[1])
                if size >= 4 * BYTES_AT_ONCE and len(held) > 1:
                    yield compared(held)
                    held = held[-1:]
                    size = len(held[0][1])
        if held:
            yield compared(held)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return map_texts(_with_next(docs, doc_id, text), run, schema)
