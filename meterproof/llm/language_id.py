"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Letters are lower-cased, everything else is a space. Every n-gram of ORDERS letters is hashed
into 2**BITS features; a feature's value is its share of the text's n-grams times its inverse
document frequency, counted over all training documents. Weights are learned by
follow-the-regularised-leader with elastic-net penalties on a bounded sample (SAMPLE documents,
shared out among the languages), then a temperature is fitted on a part kept aside. As a value
is linear in the n-gram counts, scoring a text is one gather and one sum per language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterproof.llm.common import in_arrow, ragged, stored

ORDERS = (2, 3)
BITS = 16
#: Bound on the documents that weights are fitted on, and the share kept aside for the temperature.
SAMPLE = 6000
ASIDE = 5
#: Features of a sampled text that weights are fitted on, the most frequent ones; only long texts have more.
NONZERO = 1024
PASSES = 3
ALPHA, BETA, L1, L2 = 0.5, 0.1, 1e-4, 1e-4
#: Values are shares of a text, hence small; this brings a text's vector to about unit length.
SCALE = 10.0
SLICE = 1 << 20
UNKNOWN = "und"
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _letters() -> np.ndarray:
    table = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        if chr(code).isalpha():
            table[code] = code
    return table


_LETTERS: list[np.ndarray] = []


def codes_of(text: str) -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(_letters())
    return _LETTERS[0][np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)]


def grams(codes: np.ndarray, order: int) -> np.ndarray:
    """Feature of the n-gram at each place where one begins."""
    n = max(0, len(codes) - order + 1)
    value = codes[:n].astype(np.uint64) + np.uint64(order << 32)
    for k in range(1, order):
        value = (value ^ (value >> np.uint64(29))) * _MIX[k & 1] + codes[k : n + k]
    return ((value * _MIX[0]) >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: str) -> Iterator[np.ndarray]:
    """All n-grams of a whole text as features, a slice at a time."""
    codes = codes_of(text)
    for start in range(0, len(codes), SLICE):
        for order in ORDERS:
            yield grams(codes[start : start + SLICE + order - 1], order)


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, docs = np.zeros(1 << BITS, np.int64), 0
    here = np.zeros(1 << BITS, bool)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            here[:] = False
            for part in features(text):
                here[part] = True
            found += here
            docs += 1
    if docs:
        used = np.flatnonzero(found)
        ids, counts = np.append(used, -1), np.append(found[used], docs)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(counts, pa.int64())], ["feature", "docs"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, shares, sizes = [], [], []
        for text in batch.column(1).to_pylist():
            used, n = np.unique(np.concatenate(list(features(text))), return_counts=True)
            total = n.sum()
            if len(used) > NONZERO:
                most = np.sort(np.argsort(-n, kind="stable")[:NONZERO])
                used, n = used[most], n[most]
            ids.append(used)
            shares.append(n / total)
            sizes.append(len(used))
        sizes = np.array(sizes, np.int64)
        flat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), ragged(flat(ids, np.int64), sizes, pa.int32()), ragged(flat(shares, float), sizes, pa.float64())],
            ["lang", "key", "ids", "shares"],
        )


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray  # languages x features, inverse document frequencies multiplied in
    bias: np.ndarray
    temperature: float

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return softmax(logits / self.temperature)

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for part in features(text):
            n += len(part)
            for k, row in enumerate(self.weights):
                total[k] += row[part].sum(dtype=np.float64)
        return total / max(1, n) + self.bias


def softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return shifted / shifted.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], languages: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of follow-the-regularised-leader over sparse rows (class, ids, values)."""
    z, n = np.zeros((languages, size + 1)), np.zeros((languages, size + 1))
    order = np.random.default_rng(7)

    def weights(at: np.ndarray) -> np.ndarray:
        zs, ns = z[:, at], n[:, at]
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(ns)) / ALPHA + L2)

    for _ in range(PASSES):
        for i in order.permutation(len(rows)):
            truth, ids, values = rows[i]
            at, x = np.append(ids, size), np.append(values, 1.0)
            w = weights(at)
            p = softmax(w @ x)
            p[truth] -= 1
            g = p[:, None] * x
            sigma = (np.sqrt(n[:, at] + g * g) - np.sqrt(n[:, at])) / ALPHA
            z[:, at] += g - sigma * w
            n[:, at] += g * g
    whole = weights(np.arange(size + 1))
    return whole[:, :-1], whole[:, -1]


def fit_temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """Temperature of the least log loss, by golden section on its logarithm.

    Targets are smoothed by one part in the number of rows: separable rows do not say that
    every further answer is certain.
    """
    if not len(truth):
        return 1.0
    rest = 1 / (len(truth) + 2)

    def loss(log_t: float) -> float:
        p = np.log(np.maximum(softmax(logits / np.exp(log_t)), 1e-12))
        right = p[np.arange(len(truth)), truth]
        wrong = (p.sum(axis=1) - right) / max(1, p.shape[1] - 1)
        return float(-((1 - rest) * right + rest * wrong).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    a, b = high - ratio * (high - low), low + ratio * (high - low)
    for _ in range(40):
        if loss(a) <= loss(b):
            high, a, b = b, high - ratio * (b - low), a
        else:
            low, a, b = a, b, low + ratio * (high - a)
        a, b = high - ratio * (high - low), low + ratio * (high - low)
    return float(np.exp((low + high) / 2))


def remainder(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def has_letter(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def train(docs: DataFrame, doc_id: str = "doc_id", sample: int = SAMPLE) -> Model | None:
    """A model of the non-null languages of the documents outside the held-out quarter.

    Document frequencies count every such row. The sample takes up to an equal share of each language's
    documents, drawn by the hash of id and text: NULL, repeated and unique ids are drawn alike, and
    copies of one row count once. Texts without a letter teach nothing; without any other there is no model.
    """
    learnable = F.coalesce(remainder(doc_id) != 2, F.lit(True)) & F.col("lang").isNotNull() & has_letter()
    known = docs.where(learnable).select("lang", "text", F.xxhash64(doc_id, "text").alias("key"))
    counts = in_arrow(known.select("text"), _presence, "feature int, docs long").groupBy("feature").agg(F.sum("docs").alias("docs")).collect()
    if not counts:
        return None
    found = np.zeros(1 << BITS)
    total = 0
    for feature, docs_with in counts:
        if feature < 0:
            total = docs_with
        else:
            found[feature] = docs_with
    idf = np.log((1 + total) / (1 + found)) + 1
    # Rows of one id and text are the same document; NULL and repeated ids do not make them so.
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).collect()}
    languages = sorted(sizes)
    share = max(1, sample // len(languages))
    # Lots are even in [0, 1): a bound of twice the share leaves each language about 2 * share documents
    # to rank, however large it is and however often they are repeated.
    lot = F.pmod("key", F.lit(1 << 32)) / (1 << 32)
    bound = F.element_at(F.create_map(*[F.lit(x) for language in languages for x in (language, 2 * share / max(1, sizes[language]))]), F.col("lang"))
    drawn = known.where(lot < bound).dropDuplicates(["lang", "key"])
    counted = in_arrow(drawn.select("lang", "text", "key"), _counted, "lang string, key long, ids array<int>, shares array<double>")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("key", F.lit(1 << 32)), "key"))
    ranked = stored(counted.withColumn("place", place).where(F.col("place") <= share), "sample")
    # At most `sample` rows of NONZERO features.
    table = ranked.select("lang", (F.col("place") % ASIDE).alias("fold"), "ids", "shares").orderBy("lang", "place").toArrow()
    index = {language: i for i, language in enumerate(languages)}
    fit, aside = [], []
    for lang, fold, ids, shares in zip(*(table.column(c) for c in ("lang", "fold", "ids", "shares"))):
        ids, shares = ids.values.to_numpy(), shares.values.to_numpy()
        (aside if fold.as_py() == 0 else fit).append((index[lang.as_py()], ids, shares * idf[ids] * SCALE))
    weights, bias = fit_ftrl(fit or aside, len(languages), 1 << BITS)
    logits = np.array([weights[:, ids] @ x + bias for _, ids, x in aside]).reshape(-1, len(languages))
    temperature = fit_temperature(logits, np.array([t for t, _, _ in aside], np.int64))
    return Model(languages, (weights * idf * SCALE).astype(np.float32), bias, temperature)


def _predicting(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for text, lettered in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if not lettered:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = model.probabilities(model.logits(text))
                best = int(p.argmax())
                names.append(model.languages[best])
                scores.append(round(float(p[best]), 6))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: Model | None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row of `docs`: its id, held_out, lang_pred and score, the calibrated probability.

    A NULL text, or one without a letter, is `und` with score 0, and so is every text if there
    was nothing to learn from. Equal probabilities go to the first language by name. A NULL id
    is not held out; repeated rows get equal answers; only id and text are read, so further
    columns may have any name; an empty table gives an empty result.
    """
    held = F.coalesce(remainder(doc_id) == 2, F.lit(False)).alias("held_out")
    rows = docs.select(F.col(doc_id).alias("id"), held, F.col(text).alias("text"), has_letter(text).alias("lettered"))
    if model is None:
        done = rows.select("id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    else:
        kind = rows.schema["id"].dataType.simpleString()
        done = in_arrow(rows, _predicting(model), f"id {kind}, held_out boolean, lang_pred string, score double")
    return done.withColumnRenamed("id", doc_id)
