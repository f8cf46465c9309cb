"""Language-model scores by a hidden Markov model over token symbols."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_texts, numbered, raw_bytes
from quern.session import stage

#: Tokens that are looked up in a broadcast table; all others are joined. And levels of a count's logarithm.
HEAD_TOKENS = 1 << 18
LEVELS = 16
#: Symbols of the model: frequent tokens have one each, all others share these classes.
SYMBOLS, CLASSES = 256, 64
STATES = 8
#: Distinct tokens that a task counts before it sends them on, and symbols it holds and computes at once.
TOKENS_AT_ONCE = 1 << 19
SYMBOLS_HELD = 1 << 23
SYMBOLS_AT_ONCE = 1 << 19

#: Stands for the end of a text; no word holds white space.
END = b" "


def tokens_of(text: bytes) -> list[bytes]:
    """Words, A-Z in lower case, and the end."""
    return [*text.lower().split(), END]


def class_of(token: bytes) -> int:
    """The class of a token without a symbol of its own, by its last two bytes."""
    return zlib.crc32(token[-2:]) % CLASSES


def _class_column(token: Column) -> Column:
    return F.pmod(F.crc32(F.when(F.octet_length(token) < 3, token).otherwise(F.substring(token, -2, 2))), F.lit(CLASSES))


@dataclass
class Vocabulary:
    """Counts of the training tokens: of the most frequent by token, of all others by class."""

    counts: dict[bytes, int]
    symbols: dict[bytes, int]
    total: int
    distinct: int
    class_total: np.ndarray
    class_distinct: np.ndarray

    def base_constant(self) -> float:
        return float(np.log10(self.total + 0.5 * (self.distinct + 1)))

    def class_constants(self) -> np.ndarray:
        """log10 of what divides a token's count in its class, which has room for one unseen token."""
        return np.log10(self.class_total + 0.5 * (self.class_distinct + 1))


def count_tokens(texts: DataFrame, text: str = "text") -> DataFrame:
    """`token, c`: how often each token, ends included, occurs in all texts. Tasks send counts, not tokens."""

    def run(batches):
        counts: Counter[bytes] = Counter()
        ends = 0

        def sent():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["token", "c"])

        for batch in batches:
            for value in raw_bytes(batch.column(0)):
                counts.update(value.lower().split())
                ends += 1
                if len(counts) >= TOKENS_AT_ONCE:
                    yield sent()
                    counts.clear()
        if ends:
            counts[END] = ends
        yield sent()

    return map_texts(texts.select(text), run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame, head_tokens: int = HEAD_TOKENS) -> Vocabulary:
    """The bounded part of a stage table of counts: its most frequent tokens and sums over all of it.

    Frequent are the tokens from the lowest level of counts on that holds, with those above, at most `head_tokens`.
    """
    level = F.floor(F.log2(F.col("c")) * LEVELS)
    found = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c")).orderBy(F.desc("level")).collect()
    lowest, held = None, 0
    for row in found:
        held += row["n"]
        if held > head_tokens:
            break
        lowest = row["level"]
    head = [] if lowest is None else counts.where(level >= lowest).collect()
    ordered = sorted(((-r["c"], bytes(r["token"])) for r in head))
    symbols = {token: i for i, (_, token) in enumerate(ordered[: SYMBOLS - CLASSES])}
    totals, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in counts.groupBy(_class_column(F.col("token")).alias("class")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        totals[row["class"]], distinct[row["class"]] = row["c"], row["n"]
    known = {token: -c for c, token in ordered}
    for token in symbols:
        totals[class_of(token)] -= known[token]
        distinct[class_of(token)] -= 1
    return Vocabulary(known, symbols, sum(r["c"] for r in found), sum(r["n"] for r in found), totals, distinct)


@dataclass
class Hmm:
    """Probabilities of the first state, of the next state, and of a symbol in a state."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray

    @classmethod
    def from_pairs(cls, pairs: np.ndarray, rounds: int = 150, states: int = STATES, seed: int = 3) -> Hmm:
        """A model of the counts of neighbouring symbols, by expectation maximisation from a seeded start."""
        rng = np.random.default_rng(seed)
        pairs = pairs + 1e-3
        symbols = pairs.sum(axis=0) / pairs.sum()
        emit = symbols * np.exp(rng.normal(0, 1, (states, len(symbols))))
        emit /= emit.sum(axis=1, keepdims=True)
        joint = rng.dirichlet(np.ones(states * states)).reshape(states, states) + np.eye(states) / states
        joint /= joint.sum()
        for _ in range(rounds):
            share = pairs / np.maximum(emit.T @ joint @ emit, 1e-300)
            first = emit * ((joint @ emit) @ share.T)
            second = emit * ((joint.T @ emit) @ share)
            joint = joint * (emit @ share @ emit.T)
            joint /= joint.sum()
            emit = first + second + 1e-9
            emit /= emit.sum(axis=1, keepdims=True)
        start = joint.sum(axis=1)
        return cls(start, joint / joint.sum(axis=1, keepdims=True), emit)

    @classmethod
    def from_counts(cls, start: np.ndarray, step: np.ndarray, emit: np.ndarray, prior: np.ndarray) -> Hmm:
        """From expected counts; every symbol stays possible in every state, as `prior` has it."""
        emit = emit + prior + 0.5 / prior.shape[-1]
        step, start = step + 0.5, start + 0.5
        return cls(start / start.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def _in_step(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences of falling length side by side: all symbols step by step, the number at each step, and its start."""
    lengths = np.array([len(s) for s in sequences])
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    starts = np.cumsum(active) - active
    flat = np.empty(int(lengths.sum()), dtype=np.uint8)
    for i, s in enumerate(sequences):
        flat[starts[: len(s)] + i] = s
    return flat, active, starts


def likelihoods(model: Hmm, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 of the probability of each sequence, longest first, by the scaled forward recursion."""
    flat, active, starts = _in_step(sequences)
    emit = np.ascontiguousarray(model.emit.T)
    total = np.zeros(len(sequences))
    state = None
    for at, n in zip(starts.tolist(), active.tolist(), strict=True):
        state = (model.start if state is None else state[:n] @ model.step) * emit[flat[at : at + n]]
        scale = state.sum(axis=1)
        state = state / scale[:, None]
        total[:n] += np.log10(scale)
    return total


def expected(model: Hmm, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch: expected counts of first states, steps and emissions over sequences, longest first."""
    flat, active, starts = _in_step(sequences)
    emit = np.ascontiguousarray(model.emit.T)
    states = len(model.start)
    forward = np.empty((len(flat), states))
    scales = np.empty(len(flat))
    state = None
    spans = list(zip(starts.tolist(), active.tolist(), strict=True))
    for at, n in spans:
        state = (model.start if state is None else state[:n] @ model.step) * emit[flat[at : at + n]]
        scale = state.sum(axis=1)
        state = state / scale[:, None]
        forward[at : at + n], scales[at : at + n] = state, scale
    step = np.zeros((states, states))
    backward = np.ones((spans[-1][1], states))
    later = 0
    for at, n in reversed(spans):
        if later:
            arriving = emit[flat[after : after + later]] * backward[:later] / scales[after : after + later, None]
            step += forward[at : at + later].T @ arriving
            backward = np.ones((n, states))
            backward[:later] = arriving @ model.step.T
        forward[at : at + n] *= backward
        later, after = n, at
    first = forward[: spans[0][1]].sum(axis=0)
    emitted = np.stack([np.bincount(flat, weights=forward[:, s], minlength=emit.shape[0]) for s in range(states)])
    return first, step * model.step, emitted


def _grouped(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.Table, list[int], list[np.ndarray]]]:
    """Rows of many batches in groups: the table held, and row numbers and symbols, longest first."""
    held: list[pa.RecordBatch] = []
    size = 0

    def groups():
        table = pa.Table.from_batches(held)
        sequences = [np.frombuffer(x, dtype=np.uint8) for x in table[column].to_pylist()]
        order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        first = 0
        while first < len(order):
            last, n = first, 0
            while last < len(order) and (last == first or n + len(sequences[order[last]]) <= SYMBOLS_AT_ONCE):
                n += len(sequences[order[last]])
                last += 1
            yield table, order[first:last], [sequences[i] for i in order[first:last]]
            first = last

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(batch.schema.names.index(column)).nbytes
        if size >= SYMBOLS_HELD:
            yield from groups()
            held, size = [], 0
    if held:
        yield from groups()


def _summed(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of arrays that tasks have cut into `at, values` rows."""
    rows = parts.groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(size)
    for row in rows:
        out[row["at"]] = row["value"]
    return out


def _as_rows(values: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(values)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(values[at].astype(np.float64))], ["at", "value"])


def baum_welch(symbols: DataFrame, rounds: int, states: int = STATES) -> Hmm:
    """Train on all of `symbols`, a stage table with a binary column of that name.

    Counts of neighbouring symbols start the model; then each round adds up the expected counts of whole
    sequences over all partitions. What reaches the driver are sums of fixed size.
    """

    def neighbours(batches):
        total = np.zeros(SYMBOLS * SYMBOLS)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                data = np.frombuffer(value, dtype=np.uint8).astype(np.int32)
                np.add.at(total, data[:-1] * SYMBOLS + data[1:], 1) if len(data) < 64 else total.__iadd__(
                    np.bincount(data[:-1] * SYMBOLS + data[1:], minlength=SYMBOLS * SYMBOLS)
                )
        yield _as_rows(total)

    pairs = _summed(symbols.select("symbols").mapInArrow(neighbours, "at long, value double"), SYMBOLS * SYMBOLS)
    pairs = pairs.reshape(SYMBOLS, SYMBOLS)
    used = (pairs.sum(axis=0) + pairs.sum(axis=1) + 1) / (2 * pairs.sum() + SYMBOLS)
    model = Hmm.from_pairs(pairs, states=states)
    for _ in range(rounds):
        now = model

        def counted(batches, now=now):
            sums = [np.zeros(states), np.zeros((states, states)), np.zeros((states, SYMBOLS))]
            for _, _, sequences in _grouped(batches, "symbols"):
                for total, part in zip(sums, expected(now, sequences), strict=True):
                    total += part
            yield _as_rows(np.concatenate([s.ravel() for s in sums]))

        flat = _summed(
            symbols.select("symbols").mapInArrow(counted, "at long, value double"), states + states * states + states * SYMBOLS
        )
        first, step, emit = np.split(flat, [states, states + states * states])
        model = Hmm.from_counts(first, step.reshape(states, states), emit.reshape(states, SYMBOLS), used)
    return model


def _encoded(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """`doc_id, held_out, row, n_tokens, n_known, logs, divided, symbols, rare, times`, read once from the texts.

    `logs` is the sum of log10(c + 0.5) over tokens in the broadcast table, `divided` that of the class constants
    and `own` that of the tokens with a symbol of their own; `rare` are all other tokens with their `times`.
    """
    sent = docs.sparkSession.sparkContext.broadcast(known)  # at most HEAD_TOKENS tokens

    def run(batches):
        vocabulary = sent.value
        own = len(vocabulary.symbols)
        order = sorted(vocabulary.counts, key=lambda t: vocabulary.symbols.get(t, own))
        index = {token: i for i, token in enumerate(order)}
        logs = np.log10(np.array([vocabulary.counts[t] for t in order] + [1.0]) + 0.5)
        symbol = np.array([i if i < own else SYMBOLS - CLASSES + class_of(t) for i, t in enumerate(order)] + [0], dtype=np.uint8)
        constants = np.zeros(SYMBOLS)
        constants[SYMBOLS - CLASSES :] = vocabulary.class_constants()
        get = index.get
        names = ["doc_id", "held_out", "row", "n_tokens", "n_known", "logs", "own", "divided", "symbols", "rare", "times"]
        for batch, numbers in numbered(batches):
            out: list[list] = [[] for _ in names[3:]]
            for value in raw_bytes(batch.column(2)):
                tokens = tokens_of(value)
                at = np.array([get(t, -1) for t in tokens], dtype=np.int64)
                missing = np.flatnonzero(at < 0)
                codes = symbol[at]
                rare: Counter[bytes] = Counter()
                if len(missing):
                    words = [tokens[i] for i in missing.tolist()]
                    codes[missing] = [SYMBOLS - CLASSES + class_of(w) for w in words]
                    rare.update(words)
                found = at >= 0
                each = np.where(found, logs[at], 0.0)
                values = (
                    len(tokens), len(tokens) - len(missing), float(each.sum()), float(each[found & (at < own)].sum()),
                    float(constants[codes].sum()), codes.tobytes(), list(rare), list(rare.values()),
                )
                for column, x in zip(out, values, strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(numbers, pa.int64()), *(pa.array(v, t) for v, t in zip(out, types, strict=True))], names
            )

    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
    schema = (
        "doc_id long, held_out boolean, row long, n_tokens long, n_known long, logs double, own double, divided double,"
        " symbols binary, rare array<binary>, times array<long>"
    )
    return map_texts(docs, run, schema)


def score_texts(docs: DataFrame, held_out: Column, rounds: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`: one row per document.

    The model learns from every document for which `held_out` (of the columns of `docs`) is not true. Frequent
    tokens are symbols of their own; another token is its class's symbol and, within the class, as likely as its
    count has it, with room for one unseen token. `score` is the exact log10 probability of the text: the forward
    recursion over its symbols plus the logarithms within classes. `base_score` is that of the tokens one by one.

    Texts are read twice. Counts, pairs and expected counts cover all training texts. Of all counts a bounded,
    most frequent part is broadcast; tokens beyond it are joined with their counts, one row per document and
    token. Null texts are empty: an end alone. A null `held_out` counts as false. Rows that repeat are texts of
    their own. Without training texts the base has one unseen token, and `train_tokens` is 0.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text")
    )
    counts = stage(count_tokens(rows.where(~F.col("held_out"))), "token-counts")
    known = vocabulary(counts)
    coded = stage(_encoded(rows, known), "symbols")
    model = baum_welch(coded.where(~F.col("held_out")), rounds)

    rare = coded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "row", F.col("x.rare").alias("token"), F.col("x.times").alias("times")
    )
    c = F.coalesce("c", F.lit(0))
    looked_up = (
        rare.join(counts, "token", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(c + F.lit(0.5))).alias("rare_logs"),
            F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )

    def forward(batches):
        for table, at, sequences in _grouped(batches, "symbols"):
            found = table.drop_columns(["symbols"]).take(pa.array(at))
            found = found.append_column("forward", pa.array(likelihoods(model, sequences)))
            yield from found.combine_chunks().to_batches()

    columns = ["doc_id", "held_out", "row", "n_tokens", "n_known", "logs", "own", "divided"]
    schema = "doc_id long, held_out boolean, row long, n_tokens long, n_known long, logs double, own double, divided double, forward double"
    scored = coded.select(*columns, "symbols").mapInArrow(forward, schema).join(looked_up, "row", "left")
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(known.base_constant())).alias("base_score"),
        (F.col("forward") + logs - F.col("own") - F.col("divided")).alias("score"),
    )
