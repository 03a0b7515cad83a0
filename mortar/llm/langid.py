"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash63, sample_cut, text_or_empty, worker_cache

#: n-grams of 1 to 3 characters are hashed to so many features.
ORDERS = 3
FEATURES = 1 << 15
#: Labelled texts the weights are fitted on, about, over all languages together.
MOST_LABELLED = 4_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1
#: Characters whose n-grams are counted at a time; a longer text is counted in blocks.
BLOCK = 1 << 20
UNKNOWN = "und"


def letters() -> np.ndarray:
    """For every code point whether it is a letter (Unicode categories L)."""
    cache = worker_cache()
    if "letters" not in cache:
        cache["letters"] = np.array([chr(i).isalpha() for i in range(0x110000)])
    return cache["letters"]


def ngram_counts(text: str, is_letter: np.ndarray) -> np.ndarray | None:
    """How often each hashed n-gram occurs in the whole lower-cased text; None without letters.

    What is not a letter counts as a word gap, gaps in a row as one.
    """
    counts, found, carry = np.zeros(FEATURES, dtype=np.int64), False, np.array([32], dtype=np.uint32)
    for begin in range(0, len(text), BLOCK):
        points = np.frombuffer(text[begin : begin + BLOCK].lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        known = is_letter[points]
        found = found or bool(known.any())
        points = np.concatenate([carry, np.where(known, points, 32).astype(np.uint32)])
        points = points[(points != 32) | np.concatenate([[True], points[:-1] != 32])]
        fresh = len(carry)
        code = points
        for n in range(1, ORDERS + 1):
            # the n-gram that ends at each place; those that end in the carry are counted already
            if n > 1:
                code = code[: len(points) - n + 1] * np.uint32(0x9E3779B1) + points[n - 1 :]
            mixed = code * np.uint32(0x85EBCA6B) + np.uint32(n)
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0xC2B2AE35)
            mixed = mixed[max(0, fresh - n + 1) :]
            counts += np.bincount((mixed >> np.uint32(17)) & np.uint32(FEATURES - 1), minlength=FEATURES)
        carry = points[-(ORDERS - 1) :]
    return counts if found else None


def tfidf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(counts)
    value = np.log1p(counts[at]) * idf[at]
    norm = np.sqrt((value * value).sum())
    return at, value / norm if norm else value


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # feature, language; the last row is the bias
    temperature: float

    def predict(self, counts: np.ndarray | None) -> tuple[str, float]:
        if counts is None or not self.languages:
            return UNKNOWN, 0.0
        at, value = tfidf(counts, self.idf)
        p = softmax((value @ self.weights[at] + self.weights[-1]) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, seed: int = 0) -> np.ndarray:
    """Follow the regularised leader, per coordinate, with L1 and L2 penalties on the weights."""
    z = np.zeros((FEATURES + 1, classes))
    n = np.zeros_like(z)
    order = np.random.default_rng(seed)

    def weights(at) -> np.ndarray:
        sparse = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, sparse)

    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, value = np.append(rows[i][0], FEATURES), np.append(rows[i][1], 1.0)
            w = weights(at)
            error = softmax(value @ w)
            error[y[i]] -= 1
            g = value[:, None] * error
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(slice(None))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on rows that the weights haven't seen."""
    tries = np.exp(np.linspace(np.log(0.02), np.log(20), 200))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in tries]
    return float(tries[int(np.argmin(loss))])


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Over all rows of ``texts`` (one column): how many have letters, and in how many each feature occurs.

    Each task adds up its own rows; only ``FEATURES`` sums come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter, total, n = letters(), np.zeros(FEATURES + 1, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                counts = ngram_counts(text.as_py(), is_letter)
                if counts is not None:
                    total[:-1] += counts > 0
                    n += 1
        total[-1] = n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["feature", "n"])

    summed = texts.mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(FEATURES + 1, dtype=np.int64)
    for r in summed:
        found[r["feature"]] = r["n"]
    return int(found[-1]), found[:-1]


def training_rows(id_col: Column, lang: Column, sizes: dict[str, int], most: int) -> Column:
    """About ``most`` labelled rows, as many of each language, all of a language that has fewer."""
    each = max(1, most // len(sizes))
    cuts = F.map_from_arrays(F.lit(list(sizes)), F.array(*[F.lit(sample_cut(each, n)).cast("long") for n in sizes.values()]))
    return hash63(id_col) <= F.try_element_at(cuts, lang)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = MOST_LABELLED) -> LanguageModel:
    """Learn from the rows that are not held out.

    Document frequencies cover all of them. Weights are fitted on about ``most`` labelled
    rows, evenly many of each language and chosen by a hash of the id; a fifth of them sets
    the temperature. Without labelled rows the model answers ``und``.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("_id"), text_or_empty(F.col(f"`{text_col}`")).alias("_text"), F.col(f"`{lang_col}`").cast("string").alias("_lang")
    ).where(~held_out(F.col("_id")))
    labelled = rows.where(F.col("_lang").isNotNull())
    sizes = {r["_lang"]: r["n"] for r in labelled.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "_lang").limit(most).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros(FEATURES), np.zeros((FEATURES + 1, 0)), 1.0)
    n, df = document_frequencies(rows.select("_text"))
    idf = np.log((1 + n) / (1 + df)) + 1.0

    chosen = labelled.where(training_rows(F.col("_id"), F.col("_lang"), sizes, most))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter = letters()
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                counts = ngram_counts(text.as_py(), is_letter)
                if counts is not None:
                    at, value = tfidf(counts, idf)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang.as_py()]), pa.array([at.astype("<u2").tobytes()]), pa.array([value.astype("<f4").tobytes()])], names=["lang", "at", "value"]
                    )

    # texts become vectors where they are; the limit is for ids that repeat without end, which share a hash
    got = chosen.select("_text", "_lang").mapInArrow(vectors, "lang string, at binary, value binary").limit(2 * most).toLocalIterator()
    found = [(r["lang"], bytes(r["at"]), bytes(r["value"])) for r in got]
    found.sort()  # the same model whatever the order of the rows
    order = np.random.default_rng(1).permutation(len(found))
    data = [(np.frombuffer(found[i][1], "<u2").astype(np.int64), np.frombuffer(found[i][2], "<f4").astype(float)) for i in order]
    y = np.array([languages.index(found[i][0]) for i in order], dtype=np.int64)
    if not len(y):
        return LanguageModel([], idf, np.zeros((FEATURES + 1, 0)), 1.0)
    cut = max(1, len(y) * 4 // 5)
    weights = ftrl(data[:cut], y[:cut], len(languages))
    logits = np.array([v @ weights[at] + weights[-1] for at, v in data[cut:]])
    return LanguageModel(languages, idf, weights, temperature(logits, y[cut:]) if len(logits) else 1.0)


def predict_language(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row, from its whole text alone.

    A null text or one without letters gets ``und`` and score 0; so do all rows if nothing
    was learned. Rows that repeat get equal answers; other columns are left alone.
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double"
    spark = docs.sparkSession
    # the model has a fixed number of features: a few MB for some languages
    shared = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter, model = letters(), shared.value
        for batch in batches:
            found = [model.predict(ngram_counts(t.as_py(), is_letter)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=[id_col, "lang_pred", "score"]
            )

    return docs.select(F.col(f"`{id_col}`"), text_or_empty(F.col(f"`{text_col}`"))).mapInArrow(predict, schema)
