"""Language identification by blended-spectrum string kernels, Nystroem landmarks and ridge regression."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_texts

#: The model is fitted on about so many labelled documents, alike for every language and one of each at least; of longer
#: ones on a window of so many characters. So many of the documents are landmarks.
FIT_DOCUMENTS = 3000
FIT_CHARACTERS = 16_384
LANDMARKS = 240
#: Documents whose kernels are multiplied at once.
ROWS_AT_ONCE = 64

UNDETERMINED = "und"
_BUCKET_BITS = 18
_WORDLIKE = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether a text has a letter; other numerals than digits, such as a half, are none."""
    return any(m.group().isalpha() for m in _WORDLIKE.finditer(text))


def grams_of(text: bytes) -> list[np.ndarray]:
    """Buckets of the 1-, 2- and 3-grams of a text's bytes, A-Z in lower case, with a blank around it."""
    data = np.frombuffer(b" " + text.lower() + b" ", dtype=np.uint8).astype(np.uint32)
    two = data[:-1] << np.uint32(8) | data[1:]
    three = two[:-1] << np.uint32(8) | data[2:]
    shift = np.uint32(32 - _BUCKET_BITS)
    return [(codes + np.uint32(1)) * np.uint32(salt) >> shift for codes, salt in ((data, 2654435769), (two, 2246822519), (three, 3266489917))]


@dataclass
class LanguageModel:
    """For every known n-gram its row, and for every row a weight per language."""

    languages: list[str]
    rows: np.ndarray
    weights: np.ndarray
    #: With more languages than landmarks, `weights` are those of the landmarks, and this has theirs of the languages.
    mixed: np.ndarray | None = None

    def values(self, texts: list[bytes]) -> np.ndarray:
        """One value per text and language: normalised presence kernels with the landmarks, times their weights."""
        out = np.zeros((len(texts), len(self.languages)))
        seen = np.zeros((ROWS_AT_ONCE, len(self.weights) + 1), dtype=np.float32)  # the last column: unknown
        for start in range(0, len(texts), ROWS_AT_ONCE):
            part = texts[start : start + ROWS_AT_ONCE]
            seen[:] = 0
            for i, text in enumerate(part):
                for buckets in grams_of(text):
                    seen[i, self.rows[buckets]] = 1
            known = seen[: len(part), :-1]
            size = np.sqrt(np.maximum(known.sum(axis=1, keepdims=True), 1))
            values = known @ self.weights / size
            out[start : start + len(part)] = values if self.mixed is None else values @ self.mixed
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The best language of each text and a score from 0 to 1."""
        values = self.values([t.encode("utf-8", "replace") for t in texts])
        best = values.argmax(axis=1)
        score = np.clip((values[np.arange(len(texts)), best] + 1) / 2, 0, 1)
        lettered = [has_letter(t) for t in texts]
        names = [self.languages[b] if has else UNDETERMINED for b, has in zip(best, lettered, strict=True)]
        return names, np.where(lettered, score, 0.0)


def fit(texts: list[str], languages: list[str], ridge: float = 1e-3) -> LanguageModel | None:
    """One-versus-rest kernel ridge regression in the space that the landmarks span; None without texts."""
    pairs = sorted({(l, t) for t, l in zip(texts, languages, strict=True) if has_letter(t)}, key=lambda p: (_digest(p[1]), p))
    if not pairs:
        return None
    names = sorted({l for l, _ in pairs})
    by_language = [[t for l, t in pairs if l == name] for name in names]
    each = max(1, LANDMARKS // len(names))
    # The texts of a group are in the order of their digests, and so are the groups that give landmarks if not all do.
    giving = sorted(by_language, key=lambda g: _digest(g[0]))[:LANDMARKS]
    landmarks = [t.encode() for group in giving for t in group[:each]]
    present = [np.unique(np.concatenate(grams_of(t))) for t in landmarks]
    known = np.unique(np.concatenate(present))
    rows = np.full(1 << _BUCKET_BITS, len(known), dtype=np.int32)
    rows[known] = np.arange(len(known))
    dense = np.zeros((len(known), len(landmarks)), dtype=np.float32)
    for i, p in enumerate(present):
        dense[rows[p], i] = 1 / np.sqrt(len(p))
    kernel = LanguageModel([""] * len(landmarks), rows, dense).values  # with the landmarks in place of languages
    values, vectors = np.linalg.eigh((dense.T @ dense).astype(np.float64))
    kept = values > 1e-6 * values[-1]
    project = vectors[:, kept] / np.sqrt(values[kept])
    x = kernel([t.encode() for _, t in pairs]) @ project
    y = np.where(np.array([l for l, _ in pairs])[:, None] == np.array(names)[None, :], 1.0, -1.0)
    weight = (1 / np.array([len(g) for g in by_language]))[[names.index(l) for l, _ in pairs], None]
    weight = weight / weight.mean()
    solved = np.linalg.solve((x * weight).T @ x + ridge * len(x) * np.eye(x.shape[1]), (x * weight).T @ y)
    mixed = (project @ solved).astype(np.float32)
    if len(names) > len(landmarks):
        return LanguageModel(names, rows, dense, mixed)
    return LanguageModel(names, rows, (dense @ (project @ solved)).astype(np.float32))


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), 9)


def train(docs: DataFrame, where: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel | None:
    """Fit on documents for which `where` (of `doc_id`) holds, about as many of every language, drawn by a digest of ids.

    Rows with a null language, or without a letter in their text, are not learnt from; every other language is a class of
    the model, however many there are, and gives one document at least. Of a long document a window is learnt that its
    digest draws. Rows that repeat are drawn together; without rows there is no model.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where(
        where & F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")
    )
    known = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # the model's classes
    if not known:
        return None
    spark = docs.sparkSession
    # Every language gives its share of the bound, on average.
    each = FIT_DOCUMENTS / len(known)
    shares = spark.createDataFrame([(r["lang"], min(1.0, each / r["n"])) for r in known], "known string, share double")
    drawn = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    order = F.struct(drawn.alias("drawn"), F.col("doc_id"), F.xxhash64("text").alias("digest"))
    met = rows.join(F.broadcast(shares), F.col("lang") == F.col("known"))
    picked = met.where(drawn < F.col("share")).orderBy(order).limit(2 * FIT_DOCUMENTS)
    fitted = [tuple(r) for r in picked.select("lang", _window("text").alias("text")).collect()]
    missing = [(r["lang"],) for r in known if r["lang"] not in {name for name, _ in fitted}]
    if missing:
        left = F.broadcast(spark.createDataFrame(missing, "known string"))
        first = rows.join(left, F.col("lang") == F.col("known")).groupBy("lang").agg(F.min_by(_window("text"), order).alias("text"))
        fitted += [tuple(r) for r in first.collect()]
    return fit([t for _, t in fitted], [name for name, _ in fitted])


def _window(text: str) -> Column:
    """A text of at most `FIT_CHARACTERS`, or so many of a longer one from a drawn place; from the first letter if the place has none."""
    over = F.length(text) - FIT_CHARACTERS
    start = F.pmod(F.xxhash64(F.lit("window"), text), F.greatest(over, F.lit(0)) + 1).cast("int") + 1
    window = F.substring(F.col(text), start, F.lit(FIT_CHARACTERS))
    first = F.substring(F.regexp_replace(text, "^\\P{L}+", ""), 1, FIT_CHARACTERS)
    return F.when(over <= 0, F.col(text)).when(window.rlike("\\p{L}"), window).otherwise(first)


def identify(docs: DataFrame, model: LanguageModel | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, lang_pred, score`: one row per document, from its whole text alone; no shuffle.

    Null texts, texts without a letter and, without a model, all texts are `und` with score 0. Repeated rows are
    judged each, and an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the n-gram buckets and the languages

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            if sent.value is None:
                names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            else:
                names, scores = sent.value.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_texts(rows, run, "doc_id long, lang_pred string, score double")
