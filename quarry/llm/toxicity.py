"""Toxicity by a counterfactually regularised logistic classifier.

Features are the words of the whole text, their first four to seven letters, and
those beginnings that occur more than once; each is present or not. Training takes a bounded sample of labelled documents
(``MAX_ROWS`` per class, those with the smallest hash of the identifier; class
weights restore the proportions of all labelled rows). Features that do not
depend on the label by a chi-square test are dropped.

Neutral mentions of a group must not raise the score: each sentence of a
labelled document that names a group is paired with the same sentence naming
another group of the same kind, and the loss has a penalty on the squared change
of the score's logit within each pair.

Scoring is one pass of ``mapInArrow`` over whole texts with the weights (at
most ``MAX_FEATURES``) in the task's closure.

Defined results: null and empty texts get the score of a text without words; a
document with several labels counts as toxic if one says so; null labels are
ignored; very long texts are scored whole, and learned from whole; rows of equal hash
are sampled in the order of their identifiers; without both classes the score is the share of toxic labels; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import column_of, stage, whole_row

MAX_ROWS = 8000
MAX_FEATURES = 20000
CHI_SQUARE = 20.0
PENALTY = 4.0
RIDGE = 2e-5

# Terms that name groups, by kind.
IDENTITY_TERMS = {
    "religion": ["buddhist", "catholic", "christian", "hindu", "jewish", "muslim", "sikh", "atheist"],
    "origin": ["african", "american", "arab", "asian", "chinese", "european", "indian", "mexican", "turkish"],
    "colour": ["black", "white", "brown"],
    "gender": ["female", "male", "transgender", "nonbinary"],
    "people": ["women", "men", "girls", "boys"],
    "orientation": ["gay", "lesbian", "bisexual", "straight", "queer"],
    "age": ["old", "young", "elderly"],
    "ability": ["blind", "deaf", "disabled", "autistic"],
}
_KIND = {term: kind for kind, terms in IDENTITY_TERMS.items() for term in terms}
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


PREFIXES = (4, 5, 6, 7)


def features(text: str | None) -> set[str]:
    """Distinct words, their beginnings, and the beginnings that at least two
    words of the text share (``+``)."""
    counts = Counter(_WORD.findall((text or "").lower()))
    found = set(counts)
    for n in PREFIXES:
        begins: dict[str, int] = {}
        for w, times in counts.items():
            if len(w) >= n:
                begin = w[:n]
                begins[begin] = begins.get(begin, 0) + times
        for begin, times in begins.items():
            found.add(begin + "-")
            if times > 1:
                found.add(begin + "+")
    return found


def swapped_sentences(text: str | None) -> list[tuple[str, str]]:
    """Sentences that name a group, and the same with another group's name."""
    out = []
    for sentence in _SENTENCE.split((text or "").lower()):
        words = _WORD.findall(sentence)
        if any(w in _KIND for w in words):

            def other(w):
                terms = IDENTITY_TERMS[_KIND[w]]
                return terms[(terms.index(w) + 1) % len(terms)]

            out.append((" ".join(words), " ".join(other(w) if w in _KIND else w for w in words)))
    return out


def held_out(id_col="doc_id", folds: int = 4, fold: int = 2):
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == fold


class Model:
    """Weights by feature and the bias."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.words = frozenset(f for f in weights if f[-1] not in "-+")
        self.begins = {n: frozenset(f[:-1] for f in weights if f[-1] in "-+" and len(f) == n + 1) for n in PREFIXES}

    def score(self, text: str | None) -> float:
        """The same as summing the weights of ``features``, but only the words
        and beginnings that have a weight are counted."""
        words = _WORD.findall((text or "").lower())
        distinct = set(words)
        found = sorted(distinct & self.words)
        for n, known in self.begins.items():
            hits = {w for w in distinct if w[:n] in known}
            if hits:
                times = Counter(w[:n] for w in words if w in hits)
                found += [b + "-" for b in sorted(times)] + [b + "+" for b in sorted(times) if times[b] > 1]
        z = self.bias + sum(self.weights.get(f, 0.0) for f in found)
        return float(1.0 / (1.0 + np.exp(-max(min(z, 40.0), -40.0))))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS):
    """The bounded sample as (text, label, weight) and the share of toxic labels."""
    known = (
        labels.where("toxic is not null and doc_id is not null")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    known, _ = stage(known.where("toxic in (0, 1)"), "labels")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    picked = None
    for label in (0, 1):
        best = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
        picked = best if picked is None else picked.union(best)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])
    found = rows.select("doc_id", "text", "toxic").orderBy("doc_id").toArrow()
    toxic = np.array(found.column("toxic").to_pylist(), dtype=np.float64)
    texts = found.column("text").to_pylist()
    weight = np.ones(len(toxic))
    for label in (0, 1):
        if (toxic == label).any():
            weight[toxic == label] = counts.get(label, 0) / (toxic == label).sum()
    return texts, toxic, weight


def fit(texts: list[str], toxic: np.ndarray, weight: np.ndarray, rounds: int = 300) -> Model:
    """Weighted logistic regression with ridge and counterfactual penalty."""
    total = weight.sum()
    share = float((weight * toxic).sum() / total) if total else 0.0
    share = min(max(share, 1e-6), 1 - 1e-6)
    prior = float(np.log(share / (1 - share)))
    if not len(toxic) or toxic.min() == toxic.max():
        return Model({}, prior)

    in_toxic, in_clean, pairs = Counter(), Counter(), []
    for text, label in zip(texts, toxic, strict=True):
        (in_toxic if label else in_clean).update(features(text))
        pairs += swapped_sentences(text)
    n1, n0 = toxic.sum(), len(toxic) - toxic.sum()
    chi = {}
    for f in in_toxic.keys() | in_clean.keys():
        a, b = in_toxic[f], in_clean[f]
        if a + b < 5 or a + b == n1 + n0:
            continue
        c, d = n1 - a, n0 - b
        x = (n1 + n0) * (a * d - b * c) ** 2 / ((a + b) * (c + d) * n1 * n0)
        if x >= CHI_SQUARE:
            chi[f] = x
    terms = {f for pair in pairs for s in pair for f in features(s) if f.rstrip("-+") in _KIND}
    names = sorted(sorted(chi, key=lambda f: (-chi[f], f))[:MAX_FEATURES] + sorted(terms - chi.keys()))
    at = {f: i for i, f in enumerate(names)}

    def matrix(rows):
        found = [sorted(at[f] for f in features(t) if f in at) for t in rows]
        return (
            np.repeat(np.arange(len(found)), [len(x) for x in found]),
            np.array([i for x in found for i in x], dtype=np.int64),
        )

    r, c = matrix(texts)
    rp, cp = matrix([p[0] for p in pairs])
    rq, cq = matrix([p[1] for p in pairs])
    m, share_of = len(names), weight / total
    # features kept at weights of comparable size: Adam over the full batch
    w, bias = np.zeros(m), prior
    first, second = np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, rounds + 1):
        z = bias + np.bincount(r, w[c], minlength=len(toxic))
        error = share_of * (1 / (1 + np.exp(-z)) - toxic)
        grad = np.bincount(c, error[r], minlength=m) + RIDGE * w
        if pairs:
            gap = np.bincount(rp, w[cp], minlength=len(pairs)) - np.bincount(rq, w[cq], minlength=len(pairs))
            gap *= 2 * PENALTY / len(pairs)
            grad += np.bincount(cp, gap[rp], minlength=m) - np.bincount(cq, gap[rq], minlength=m)
        g = np.append(grad, error.sum())
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        step = 0.15 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return Model({f: float(x) for f, x in zip(names, w, strict=True) if abs(x) > 1e-6}, float(bias))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    return fit(*training_rows(docs, labels, max_rows))


def score_text(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score of ``text_col`` as one more column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(x.as_py()) for x in column_of(batch, text_col)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, score_col]
            )

    fields = [*docs.schema.fields, T.StructField(score_col, T.DoubleType())]
    return docs.mapInArrow(run, T.StructType(fields))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    scored = score_text(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents below the threshold, with all their columns."""
    rows = docs.select(whole_row(docs).alias("row"), "text")
    return score_text(rows, train(docs, labels)).where(F.col("score") < threshold).select("row.*")
