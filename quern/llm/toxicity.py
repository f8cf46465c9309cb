"""Toxicity: a support vector machine on gap-weighted subsequence kernels with Nystroem landmarks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_texts

#: The model is fitted on at most so many labelled documents of each class, of at most so many bytes each.
FIT_DOCUMENTS = 3000
FIT_BYTES = 32_768
#: Landmarks of either class.
TOXIC_LANDMARKS, CLEAN_LANDMARKS = 160, 96
#: Characters that are scored at once.
SYMBOLS_AT_ONCE = 1 << 18

#: A subsequence of three symbols may span five; every symbol passed over costs this factor.
DECAY = 0.5
_OFFSETS = [(j, k) for k in range(2, 5) for j in range(1, k)]
_SYMBOL_BITS = 6
_CODES = 1 << 3 * _SYMBOL_BITS
_DROPPED = 255

# Signs that often stand for letters.
_STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


def _symbol_table(size: int = 0x3000) -> np.ndarray:
    """Symbols of characters: white space 0, letters 1 to 63, all else dropped."""
    table = np.full(size, _DROPPED, dtype=np.uint8)
    for code in range(size):
        char = chr(code)
        char = _STANDS_FOR.get(char, char.lower()[0])
        if char.isspace():
            table[code] = 0
        elif "a" <= char <= "z":
            table[code] = ord(char) - 96
        elif char.isalnum():
            table[code] = 27 + ord(char) % 37
    return table


_TABLE = _symbol_table()


def symbols_of(text: str) -> np.ndarray:
    """The symbols of a text, one 0 around every word.

    Signs inside words are dropped, and so is white space between single letters, so that letters that
    are held apart meet.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    symbols = np.where(codes < len(_TABLE), _TABLE[np.minimum(codes, len(_TABLE) - 1)], 27 + codes % 37).astype(np.uint8)
    symbols = np.r_[np.uint8(0), symbols[symbols != _DROPPED], np.uint8(0)]
    symbols = symbols[np.r_[True, (symbols[1:] != 0) | (symbols[:-1] != 0)]]
    if len(symbols) > 4:
        blank = symbols == 0
        alone = np.zeros(len(symbols), dtype=bool)  # single letters
        alone[1:-1] = blank[:-2] & blank[2:] & ~blank[1:-1]
        between = np.zeros(len(symbols), dtype=bool)
        between[1:-1] = blank[1:-1] & alone[:-2] & alone[2:]
        symbols = symbols[~between]
    return symbols


def words_of(text: str) -> set[bytes]:
    return set(symbols_of(text).tobytes().split(b"\0")) - {b""}


def _subsequences(symbols: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, float]]:
    """For every pattern of gaps: its first positions, the codes of the subsequences there and their weight.

    A subsequence lies in one word with the 0 before and after it.
    """
    n = len(symbols)
    wide = symbols.astype(np.int32)
    word = np.cumsum(symbols == 0, dtype=np.int32)
    for j, k in _OFFSETS:
        if n <= k:
            continue
        first = np.flatnonzero(word[k - 1 : n - 1] == word[: n - k])
        codes = (wide[first] << 2 * _SYMBOL_BITS) | (wide[first + j] << _SYMBOL_BITS) | wide[first + k]
        yield first, codes, DECAY ** (k - 2)


def word_scores(symbols: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The value of every word under a weight for each subsequence, by normalised kernels."""
    total, square = np.zeros(len(symbols), dtype=np.float32), np.zeros(len(symbols), dtype=np.float32)
    for first, codes, weight in _subsequences(symbols):
        total[first] += weight * weights[codes]
        square[first] += weight * weight
    starts = np.flatnonzero(symbols == 0)[:-1]
    if not len(starts):
        return np.zeros(0, dtype=np.float32)
    return np.add.reduceat(total, starts) / np.sqrt(np.maximum(np.add.reduceat(square, starts), 1e-9))


def features(words: list[bytes]) -> list[dict[int, float]]:
    """The normalised weights of each word's subsequences; their products are the kernel."""
    found = []
    for word in words:
        values: dict[int, float] = {}
        square = 0.0
        for _, codes, weight in _subsequences(np.frombuffer(b"\0" + word + b"\0", dtype=np.uint8)):
            square += weight * weight * len(codes)
            for code in codes.tolist():
                values[code] = values.get(code, 0.0) + weight
        found.append({c: v / square**0.5 for c, v in values.items()})
    return found


def kernel(left: list[dict[int, float]], right: list[dict[int, float]]) -> np.ndarray:
    """Kernel of all words of two lists."""
    columns = {c: i for i, c in enumerate(sorted({c for f in right for c in f}))}
    dense = np.zeros((len(columns), len(right)), dtype=np.float32)
    for i, f in enumerate(right):
        for c, v in f.items():
            dense[columns[c], i] = v
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for i, f in enumerate(left):
        at = [(columns[c], v) for c, v in f.items() if c in columns]
        if at:
            rows, values = zip(*at, strict=True)
            out[i] = np.array(values, dtype=np.float32) @ dense[list(rows)]
    return out


def _svm(x: np.ndarray, y: np.ndarray, cost: float, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton's method on the vectors inside the margin."""
    x = np.c_[x, np.ones(len(x))]
    weight = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum())) * cost
    w = np.zeros(x.shape[1])
    penalty = np.eye(x.shape[1])
    penalty[-1, -1] = 1e-4
    active = None
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        if active is not None and (inside == active).all():
            break
        active = inside
        part = x[inside]
        w = np.linalg.solve(penalty + (part * weight[inside, None]).T @ part, (part * (weight * y)[inside, None]).sum(axis=0))
    return w[:-1], float(w[-1])


@dataclass
class ToxicModel:
    """A weight for each subsequence, and where the value of the worst word becomes toxic."""

    weights: np.ndarray
    threshold: float
    scale: float

    def values(self, texts: list[str]) -> np.ndarray:
        """The value of the strongest word of every text; texts without words have -inf."""
        out = np.full(len(texts), -np.inf)
        held: list[np.ndarray] = []
        rows: list[int] = []

        def score() -> None:
            if not held:
                return
            words = np.array([int((s == 0).sum()) for s in held])
            values = word_scores(np.concatenate([*held, np.zeros(1, dtype=np.uint8)]), self.weights)
            # Between two texts stand two 0s, which make an empty word.
            starts = np.cumsum(words) - words
            real = words > 1
            if real.any():
                best = np.maximum.reduceat(np.r_[values, -np.inf], np.c_[starts, starts + words - 1].ravel())[::2]
                out[np.array(rows)[real]] = best[real]

        size = 0
        for i, text in enumerate(texts):
            symbols = symbols_of(text)
            held.append(symbols)
            rows.append(i)
            size += len(symbols)
            if size >= SYMBOLS_AT_ONCE:
                score()
                held, rows, size = [], [], 0
        score()
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        z = np.clip((self.values(texts) - self.threshold) / self.scale, -30, 30)
        return 1 / (1 + np.exp(-z))


def fit(toxic: list[str], clean: list[str], cost: float = 2000.0) -> ToxicModel | None:
    """Learn from labelled documents; None if a class is missing.

    A document's label is that of its worst word, and nobody says which that is. A first guess takes words of
    toxic documents that clean ones don't have, most frequent first, until every toxic document has one. The
    machine learns them against words of clean documents, then against those that it takes for toxic.
    The threshold comes from clean documents that it didn't learn from.
    """
    toxic, clean = sorted(set(toxic)), sorted(set(clean), key=lambda t: hash_of(t))
    if not toxic or not clean:
        return None
    held_back, learnt = (clean[::2], clean[1::2]) if len(clean) > 1 else (clean, clean)
    toxic_words = [words_of(t) for t in toxic]
    clean_words = Counter(w for t in learnt for w in words_of(t))
    guess = _cover(toxic_words, Counter(w for t in clean for w in words_of(t)))
    if not guess:
        return None
    learnt_words = guess + [v for w in guess[:TOXIC_LANDMARKS] for v in _disguised(w) if v not in clean_words]
    vocabulary = sorted(clean_words)
    flat = np.frombuffer(b"\0" + b"\0".join(vocabulary) + b"\0", dtype=np.uint8)
    frequent = [w for w, _ in sorted(clean_words.items(), key=lambda x: (-x[1], x[0]))[:2000]]
    spread = vocabulary[:: max(1, len(vocabulary) // 2000)]
    negatives = sorted({*frequent, *spread})
    hard: list[bytes] = frequent
    for _ in range(4):
        landmarks = guess[:TOXIC_LANDMARKS] + hard[:CLEAN_LANDMARKS]
        anchors = features(landmarks)
        values, vectors = np.linalg.eigh(kernel(anchors, anchors).astype(np.float64))
        kept = values > 1e-4 * values[-1]
        project = vectors[:, kept] / np.sqrt(values[kept])
        words = learnt_words + negatives
        x = kernel(features(words), anchors) @ project
        y = np.r_[np.ones(len(learnt_words)), -np.ones(len(negatives))]
        w, bias = _svm(x, y, cost)
        alpha = project @ w
        weights = np.zeros(_CODES, dtype=np.float32)
        for a, f in zip(alpha, anchors, strict=True):
            for c, v in f.items():
                weights[c] += a * v
        found = word_scores(flat, weights)
        worst = np.argsort(-found, kind="stable")[:1000]
        hard = [vocabulary[i] for i in worst.tolist()]
        negatives = sorted({*negatives, *hard})
    model = ToxicModel(weights, 0.0, 1.0)
    bad, good = np.sort(model.values(toxic)), np.sort(model.values(held_back))
    model.threshold, model.scale = _cut_between(bad, good)
    return model


def _disguised(word: bytes) -> list[bytes]:
    """A word with a letter doubled, and with a strange one put in."""
    if len(word) < 5:
        return []
    at = 1 + sum(word) % (len(word) - 2)
    return [word[:at] + word[at - 1 :], word[:at] + bytes([24]) + word[at:]]


def hash_of(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


def _cover(documents: list[set[bytes]], clean: Counter) -> list[bytes]:
    """Words no clean document has that cover the documents, each as few times as it takes."""
    own = [{w for w in d if not clean[w]} for d in documents]
    left = Counter(w for d in own for w in d)
    chosen: list[bytes] = []
    counts = [0] * len(own)
    holders: dict[bytes, list[int]] = {}
    for i, d in enumerate(own):
        for w in d:
            holders.setdefault(w, []).append(i)
    need = 3  # words wanted of each document
    while left:
        word, gain = min(left.items(), key=lambda x: (-x[1], x[0]))
        if gain < 2 and chosen:
            break
        chosen.append(word)
        del left[word]
        for i in holders[word]:
            counts[i] += 1
            if counts[i] == need:
                for w in own[i]:
                    if w in left:
                        left[w] -= 1
    return chosen


def _cut_between(bad: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """A threshold with the fewest errors, where one clean document lost weighs as three missed; and a scale."""
    bad, good = bad[np.isfinite(bad)], good[np.isfinite(good)]
    points = np.unique(np.r_[bad, good])
    if len(points) < 2:
        return 0.0, 1.0
    cuts = (points[1:] + points[:-1]) / 2
    missed = np.searchsorted(bad, cuts) / max(1, len(bad))
    lost = 3 * (len(good) - np.searchsorted(good, cuts)) / max(1, len(good))
    total = missed + lost
    best = np.flatnonzero(total <= total.min() + 1e-12)
    width = (points[1:] - points[:-1])[best]
    at = best[int(width.argmax())]
    return float(cuts[at]), float(max(0.05, width.max() / 4))


def training_texts(docs: DataFrame, labels: DataFrame, where: Column, doc_id: str, text: str, label: str, seed: int) -> tuple[list[str], list[str]]:
    """Texts of labelled toxic and clean documents: those with the least digests, up to the bounds above."""
    ids = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label")).where(where & F.col("doc_id").isNotNull())
    texts: list[list[str]] = []
    for value in (1, 0):
        chosen = (
            ids.where(F.col("label") == value).select("doc_id").distinct().orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(FIT_DOCUMENTS)
        )
        rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(
            F.octet_length("text") <= FIT_BYTES
        )
        texts.append([r["text"] for r in rows.join(F.broadcast(chosen), "doc_id").select("text").collect()])
    return texts[0], texts[1]


def train(docs: DataFrame, labels: DataFrame, where: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", seed: int = 5) -> ToxicModel | None:
    """Fit on labelled documents for which `where` (of `doc_id` and `label`) holds. Null labels are not read."""
    return fit(*training_texts(docs, labels, where, doc_id, text, label, seed))


def score_texts(docs: DataFrame, model: ToxicModel | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, score`: one row per document, no shuffle; whole texts are read.

    The score grows with the strongest word of the text. Null and empty texts, and all texts without a
    model, have 0. Repeated rows are scored each, and an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # one weight for each of 2 ** 18 codes

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            scores = np.zeros(len(texts)) if sent.value is None else sent.value.scores(texts)
            scores = np.where(scores < 1e-9, 0.0, scores)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_texts(rows, run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: ToxicModel | None, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of `docs` whose text scores below `limit`, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            keep = np.ones(len(texts), dtype=bool) if sent.value is None else sent.value.scores(texts) < limit
            yield batch.filter(pa.array(keep))

    return map_texts(docs, run, docs.schema)
