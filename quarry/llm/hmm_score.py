"""Language-model scores from a hidden Markov model.

The model emits word classes: the most frequent words, ``OWN_SCALE`` times the
square root of the vocabulary, have a class each, all other words share
``ENDINGS`` classes by their last three bytes, and the end of a text has one.
Within a shared class a word has ``(c + 1) / (N_class + V_class + 1)``, ``c`` its
count in training; one unseen word per class takes the rest. So the states learn
from classes that grow slowly with the corpus, while word counts grow with it and
stay in a distributed table.

Training counts all words in Spark and runs Baum-Welch over all training texts:
tasks run scaled forward-backward recursions over blocks of texts of similar
length and add up expected counts, which are summed in two steps in Spark; only
the sums, a few numbers per class, reach the driver. Rounds go on until one
raises the likelihood by less than ``GAIN`` of itself; ``MOST_ROUNDS`` without
that raise an error. Scoring is the scaled forward recursion (exact likelihood over
all state paths) plus, per text, the sum over its rarer words, which one join with
the word table gives. Frequent words (``FREQUENT``) are looked up in the task
instead, so that join has no hot keys.

The states start from the word classes of ``SEED_TEXTS`` whole texts, chosen by
hash: a bounded sample that decides where the rounds begin, not what they count.

Defined results: null text counts as empty, which is the end token alone; rows
without an identifier have the identifier null and belong to training; repeated
rows get equal scores and are counted as often as they occur; words of equal
count are ranked by their bytes; a very long text is worked on in pieces of
``CELLS`` tokens, from the state that the piece before left, so its memory is a
few bytes a token; an empty table gives an empty result; other columns are not
read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import column_of, drop_stages, segment_sums, stage, word_codes
from quarry.llm.tokens import blocks_of

OWN_SCALE = 2.0
ENDINGS = 2048
FREQUENT = 50_000
STATES = 6
GAIN = 0.002  # of the log likelihood, by a round
MOST_ROUNDS = 200
SEED_TEXTS = 300  # texts that give the states their first, rough, emissions
CELLS = 300_000  # tokens, with padding, that a recursion works on at once
CHUNK = 2048  # numbers per row of summed counts
SUM_FAN = 32
_BLOCK_BYTES = 1 << 22
_ROWS = 200_000  # rows of a batch of counted words


def held_out(id_col="doc_id", folds: int = 7, fold: int = 2):
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == fold


def ending_of(word: bytes) -> int:
    return crc32(word[-3:]) % ENDINGS


# -------------------------------------------------------------------------- word counts


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in blocks_of(column_of(batch, "text"), _BLOCK_BYTES):
            words, codes, _ = word_codes(part)
            counts = pa.array(np.bincount(codes, minlength=len(words)).astype(np.int64))
            found = pa.RecordBatch.from_arrays([words, counts], ["word", "n"])
            for at in range(0, len(found), _ROWS):
                yield found.slice(at, _ROWS)


class Corpus:
    """Counts of the training texts: the table of words, and what is bounded."""

    def __init__(self, training: DataFrame):
        counted = training.select("text").mapInArrow(_count_words, "word binary, n bigint")
        self.words, self.path = stage(counted.groupBy("word").agg(F.sum("n").alias("c")), "words")
        self.texts = training.count()
        row = self.words.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
        # the end of a text is a token too
        self.tokens = (row["n"] or 0) + self.texts
        self.distinct = row["v"] + (1 if self.texts else 0)
        own = math.ceil(OWN_SCALE * math.sqrt(row["v"]))
        top = self.words.orderBy(F.desc("c"), "word").limit(max(FREQUENT, own)).collect()
        # the words by rank; the first ``own`` have a class each
        self.frequent = [bytes(r["word"]) for r in top]
        self.frequent_counts = np.array([r["c"] for r in top], dtype=np.int64)
        self.own = min(own, len(top))
        self.classes = self.own + ENDINGS + 1
        self.end = self.classes - 1
        ending = F.crc32(F.substring("word", -3, 3)) % ENDINGS
        sums = self.words.groupBy(ending.alias("e")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
        self.class_size = np.zeros(self.classes)
        for r in sums:
            self.class_size[self.own + r["e"]] = r["n"] + r["v"] + 1
        for word, count in zip(self.frequent[: self.own], self.frequent_counts.tolist(), strict=False):
            self.class_size[self.own + ending_of(word)] -= count + 1
        self.class_size[self.class_size == 0] = 1

    @property
    def base_log(self) -> float:
        """log10 of the unigram denominator."""
        return math.log10(self.tokens + self.distinct + 1)


# --------------------------------------------------------------------- class sequences

_SEQ = (
    "doc_id bigint, mark bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, inner double, "
    "classes binary"
)


def _ids_type(classes: int) -> str:
    return "<u2" if classes <= 1 << 16 else "<u4"


def _sequences(docs: DataFrame, corpus: Corpus) -> DataFrame:
    """Per text its classes, and the parts of the scores that frequent words
    and the end give (``base`` and ``inner``: log10 of the numerators; of
    ``inner`` also the denominators of the shared classes)."""
    frequent, own, end = corpus.frequent, corpus.own, corpus.end
    kind = _ids_type(corpus.classes)
    size_log = np.log10(np.maximum(corpus.class_size, 1.0))
    size_log[:own] = size_log[end] = 0.0
    logs = np.append(np.log10(corpus.frequent_counts + 1.0), 0.0)  # the last for words that are not frequent
    end_log = math.log10(corpus.texts + 1)
    end_known = 1 if corpus.texts else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words = pa.array(frequent, pa.binary())
        for batch in batches:
            done = 0
            for part in blocks_of(column_of(batch, "text"), _BLOCK_BYTES):
                words, codes, at = word_codes(part)
                rank = pc.fill_null(pc.index_in(words, known_words), -1).to_numpy().astype(np.int64)
                has_class = (rank >= 0) & (rank < own)
                shared = np.array([ending_of(w) for w in words.to_pylist()], dtype=np.int64)
                classes = np.where(has_class, rank, own + shared)
                inner = np.where(has_class, 0.0, logs[rank]) - size_log[classes]
                with_end = np.insert(classes[codes], at[1:], end).astype(kind)
                cuts = (at + np.arange(len(at))).tolist()
                blobs = [with_end[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(column_of(batch, c).slice(done, len(part)) for c in ("doc_id", "mark", "held_out")),
                        pa.array(np.diff(at) + 1),
                        pa.array(segment_sums((rank >= 0).astype(np.int64)[codes], at) + end_known),
                        pa.array(segment_sums(logs[rank][codes], at) + end_log),
                        pa.array(segment_sums(inner[codes], at)),
                        pa.array(blobs, pa.binary()),
                    ],
                    [f.split()[0] for f in _SEQ.split(", ")],
                )
                done += len(part)

    return docs.mapInArrow(run, _SEQ)


def _rare_words(docs: DataFrame, corpus: Corpus) -> DataFrame:
    """``doc_id, mark, word, n`` of the words that are not frequent."""
    frequent = corpus.frequent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words = pa.array(frequent, pa.binary())
        for batch in batches:
            ids, marks, done = column_of(batch, "doc_id"), column_of(batch, "mark"), 0
            for part in blocks_of(column_of(batch, "text"), _BLOCK_BYTES):
                words, codes, at = word_codes(part)
                rare = pc.is_null(pc.index_in(words, known_words)).to_numpy(zero_copy_only=False)[codes]
                row = np.repeat(np.arange(len(part)), np.diff(at))
                found, times = np.unique(row[rare] * len(words) + codes[rare], return_counts=True)
                for first in range(0, len(found), _ROWS):
                    some = found[first : first + _ROWS]
                    place = pa.array(some // len(words) + done)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(place), marks.take(place), words.take(pa.array(some % len(words))),
                         pa.array(times[first : first + _ROWS].astype(np.int32))],
                        ["doc_id", "mark", "word", "n"],
                    )
                done += len(part)

    return docs.select("doc_id", "mark", "text").mapInArrow(run, "doc_id bigint, mark bigint, word binary, n int")


# --------------------------------------------------------------------------- recursions


class Parameters:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit  # (K,), (K, K), (classes, K)

    @property
    def kind(self) -> str:
        return _ids_type(len(self.emit))


def _blocks(blobs: list[bytes], kind: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places, lengths (descending) and padded classes by time of similar texts."""
    sequences = [np.frombuffer(b, kind) for b in blobs]
    lengths = np.array([len(s) for s in sequences])
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        longest = int(lengths[order[at]])
        take = order[at : at + max(1, CELLS // longest)]
        padded = np.zeros((longest, len(take)), dtype=kind)
        for j, i in enumerate(take.tolist()):
            padded[: lengths[i], j] = sequences[i]
        yield take, lengths[take], padded
        at += len(take)


def _pieces(padded: np.ndarray) -> list[slice]:
    """The steps of a block in pieces of ``CELLS`` tokens; more than one only for
    a text longer than that."""
    size = max(1, CELLS // padded.shape[1])
    return [slice(t, t + size) for t in range(0, len(padded), size)]


def _active(lengths: np.ndarray, steps: int) -> np.ndarray:
    """How many texts are longer than t."""
    return np.searchsorted(-lengths, -np.arange(steps), side="left")


def _forward(par: Parameters, before: np.ndarray | None, active: np.ndarray, padded: np.ndarray, keep: bool):
    """One piece, from the scaled alphas of the step before it (none: the start).
    The last alphas, the scales, and with ``keep`` all alphas and the emissions."""
    steps, width = padded.shape
    alphas = np.zeros((steps, width, len(par.start))) if keep else None
    scales = np.ones((steps, width))
    emitted = par.emit[padded]
    alpha = before
    for t in range(steps):
        a = active[t]
        alpha = (np.broadcast_to(par.start, (a, len(par.start))) if alpha is None else alpha[:a] @ par.move) * emitted[t, :a]
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        scales[t, :a] = scale
        if keep:
            alphas[t, :a] = alpha
    return alpha, scales, alphas, emitted


def _likelihoods(par: Parameters, lengths: np.ndarray, padded: np.ndarray) -> np.ndarray:
    """Log likelihood of each text of a block."""
    active, alpha, logs = _active(lengths, len(padded)), None, np.zeros(padded.shape[1])
    for piece in _pieces(padded):
        alpha, scales, _, _ = _forward(par, alpha, active[piece], padded[piece], keep=False)
        logs += np.log(scales).sum(axis=0)
    return logs


def _expected(par: Parameters, lengths: np.ndarray, padded: np.ndarray, sums) -> float:
    """Add one block's expected counts to ``sums``; its log likelihood."""
    active, pieces = _active(lengths, len(padded)), _pieces(padded)
    width, k = padded.shape[1], len(par.start)
    # the alphas that each piece starts from; the last piece is run once only
    entries: list = [None]
    for piece in pieces[:-1]:
        entries.append(_forward(par, entries[-1], active[piece], padded[piece], keep=False)[0])
    start, move, emit = sums
    moves, beta, total = np.zeros((k, k)), np.ones((width, k)), 0.0
    ahead = None  # emission times beta over scale of the step after, for texts that go on
    for piece, entry in zip(reversed(pieces), reversed(entries), strict=True):
        live, classes = active[piece], padded[piece]
        _, scales, alphas, emitted = _forward(par, entry, live, classes, keep=True)
        total += float(np.log(scales).sum())
        for t in range(len(classes) - 1, -1, -1):
            if ahead is not None:
                a = len(ahead)
                moves += alphas[t, :a].T @ ahead
                beta[:a] = ahead @ par.move.T
            here = beta[: live[t]]
            ahead = emitted[t, : live[t]] * here / scales[t, : live[t], None]
            alphas[t, : live[t]] *= here
        flat = classes.ravel()
        for s in range(k):  # padding has alpha 0
            emit[:, s] += np.bincount(flat, alphas[:, :, s].ravel(), minlength=len(emit))
        if entry is None:
            start += alphas[0].sum(axis=0)
    move += moves * par.move
    return total


def _task_sums(par: Parameters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(par.start)
        sums = np.zeros(k), np.zeros((k, k)), np.zeros(par.emit.shape)
        likelihood, seen = 0.0, False
        for batch in batches:
            for _, lengths, padded in _blocks(column_of(batch, "classes").to_pylist(), par.kind):
                likelihood += _expected(par, lengths, padded, sums)
                seen = True
        if seen:
            flat = np.concatenate([[likelihood], sums[0], sums[1].ravel(), sums[2].ravel()])
            parts = [flat[i : i + CHUNK].tobytes() for i in range(0, len(flat), CHUNK)]
            salt = TaskContext.get().partitionId() % SUM_FAN
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(parts)), pa.int32()),
                    pa.array([salt] * len(parts), pa.int32()),
                    pa.array(parts, pa.binary()),
                ],
                ["part", "salt", "sums"],
            )

    return run


def _add(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(b.as_py(), np.float64) for b in group.column("sums"))
    return pa.table(
        [group.column("part").slice(0, 1), group.column("salt").slice(0, 1), pa.array([total.tobytes()], pa.binary())],
        names=["part", "salt", "sums"],
    )


def _round(training: DataFrame, par: Parameters) -> tuple[Parameters, float]:
    schema = "part int, salt int, sums binary"
    tasks = training.select("classes").mapInArrow(_task_sums(par), schema)
    some = tasks.groupBy("part", "salt").applyInArrow(_add, schema)
    rows = some.groupBy("part").applyInArrow(_add, schema).collect()  # a few numbers per class
    flat = np.concatenate([np.frombuffer(r["sums"], np.float64) for r in sorted(rows, key=lambda r: r["part"])])
    k = len(par.start)
    start, move = flat[1 : k + 1], flat[k + 1 : k + 1 + k * k].reshape(k, k)
    emit = flat[k + 1 + k * k :].reshape(-1, k)
    return _normalised(start, move, emit), float(flat[0])


def _normalised(start, move, emit) -> Parameters:
    start, move, emit = start + 0.1, move + 0.1, emit + 0.05
    return Parameters(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _histograms(classes: int):
    kind = _ids_type(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [
                np.bincount(np.frombuffer(b.as_buffer(), kind), minlength=classes).astype("<i8").tobytes()
                for b in column_of(batch, "classes")
            ]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.binary())], ["counts"])

    return run


def _first_guess(training: DataFrame, classes: int) -> Parameters:
    """Emissions around texts that differ most, among a few chosen by hash.
    Only the starting point: all counts come from all training texts."""
    picked = training.where("n_tokens > 1").orderBy(F.xxhash64("doc_id", "mark"), "doc_id", "mark").limit(SEED_TEXTS)
    found = picked.select("classes").mapInArrow(_histograms(classes), "counts binary").collect()
    rows = [np.frombuffer(r["counts"], "<i8") for r in found]
    every = np.ones(classes) * 0.01
    for r in rows:
        every += r
    every /= every.sum()
    emit = np.repeat(every[:, None], STATES, axis=1)
    if rows:
        hist = np.array([np.sqrt(r / r.sum()) for r in rows])
        chosen = [int(np.argmax(hist @ np.sqrt(every)))]
        while len(chosen) < min(STATES, len(rows)):
            chosen.append(int(np.argmin((hist @ hist[chosen].T).max(axis=1))))
        near = np.argmax(hist @ hist[chosen].T, axis=1)
        for s in range(len(chosen)):
            emit[:, s] += 3.0 * (hist[near == s] ** 2).mean(axis=0)
    stay = np.full((STATES, STATES), 0.1 / STATES) + np.eye(STATES) * 0.9
    return Parameters(np.full(STATES, 1 / STATES), stay / stay.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def fit(training: DataFrame, classes: int, gain: float = GAIN, most_rounds: int = MOST_ROUNDS) -> Parameters:
    """Baum-Welch over all rows of ``training`` (a staged table of sequences),
    until a round raises the log likelihood by less than ``gain`` of itself."""
    par = _first_guess(training, classes)
    if training.isEmpty():
        return par
    last = -math.inf
    for _ in range(most_rounds):
        # the likelihood is that of the parameters the round started from
        par, likelihood = _round(training, par)
        if likelihood - last < gain * abs(likelihood):
            return par
        last = likelihood
    raise RuntimeError(f"the likelihood still rises after {most_rounds} rounds")


def _forward_logs(sequences: DataFrame, par: Parameters) -> DataFrame:
    names = ["doc_id", "mark", "held_out", "n_tokens", "n_known", "base", "inner"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = np.zeros(len(batch))
            for places, lengths, padded in _blocks(column_of(batch, "classes").to_pylist(), par.kind):
                logs[places] = _likelihoods(par, lengths, padded)
            yield pa.RecordBatch.from_arrays(
                [*(column_of(batch, n) for n in names), pa.array(logs / math.log(10))], [*names, "path"]
            )

    schema = _SEQ.rsplit(",", 1)[0] + ", path double"
    return sequences.mapInArrow(run, schema)


def score_documents(docs: DataFrame, gain: float = GAIN) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score`` (log10 probabilities of the whole text)."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        held_out().alias("held_out"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"),
    )
    corpus = Corpus(rows.where(~F.col("held_out")))
    sequences, path = stage(_sequences(rows, corpus), "sequences")
    par = fit(sequences.where(~F.col("held_out")), corpus.classes, gain)

    counted = F.coalesce("c", F.lit(0))
    same = ["doc_id", "mark"]
    key = [F.coalesce("doc_id", F.lit(-(1 << 63))).alias("__id"), F.col("mark").alias("__mark")]
    rare = (
        _rare_words(rows, corpus)
        .join(corpus.words, "word", "left")
        .groupBy(*same)
        .agg(
            F.sum(F.when(counted > 0, F.col("n")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("n") * F.log10(counted + 1)).alias("rare_log"),
        )
        .select(*key, "rare_known", "rare_log")
    )
    # rows that agree in identifier and text have all added to the same sums
    copies = sequences.groupBy(*same).agg(F.count(F.lit(1)).alias("copies")).select(*key, "copies")
    extra = copies.join(rare, ["__id", "__mark"], "left").fillna(0, ["rare_known", "rare_log"])
    extra, extra_path = stage(extra, "rare-sums")
    drop_stages(docs.sparkSession, [corpus.path])

    scored = _forward_logs(sequences, par).join(
        extra, (F.coalesce("doc_id", F.lit(-(1 << 63))) == F.col("__id")) & (F.col("mark") == F.col("__mark"))
    )
    log = F.col("rare_log") / F.col("copies")
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + (F.col("rare_known") / F.col("copies")).cast("long")).alias("n_known"),
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + log - F.col("n_tokens") * F.lit(corpus.base_log)).alias("base_score"),
        (F.col("path") + F.col("inner") + log).alias("score"),
    )
