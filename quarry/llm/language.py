"""Language identification, word by word, with the spans of mixed texts.

Words are runs of letters (and the marks on them) of one script. A word's script,
looked up in ranges of code points, narrows its candidates to the languages that
use it. A candidate's score for a word is the log probability of the word's
character n-grams of one to four and of the word as a whole, learned from labelled
texts. A Viterbi search over a text's words, with a penalty for each switch of
language, labels them; runs of equal labels are the spans. The text's language is
the one whose spans hold most letters, and its score the share of letters they hold.

Learning counts n-grams of all labelled texts in ``BUCKETS`` hash buckets per
language: in the task first, then by language and bucket in Spark, so neither a hot
language nor a hot n-gram matters. The driver and every task hold
``BUCKETS`` numbers per language.

Defined results: null texts and texts without a letter are ``und`` with score 0
and no spans, and so is every text if nothing was learned; words in a script that
no language uses are evidence for none and go with their neighbours; ties between
languages go to the one with the better path score, then to the first by code
point. A text of any length is labelled as a whole: memory is a few dozen
bytes per word and language. Rows that agree in identifier or text are labelled
alike, each on its own; an empty table gives an empty result; other columns are
ignored, whatever their names. A missing identifier hashes as the empty string.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import column_of
from quarry.llm.tokens import blocks_of, bytes_of, code_points

BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
SWITCH = 8.0  # penalty for another language than the word before, in nats
WORST = 12.0  # a word speaks against a candidate by this much at most
SMOOTH = 0.5
SCRIPT_SHARE = 0.01  # of its letters that make a script one of a language's
UNKNOWN = "und"
_BLOCK_BYTES = 1 << 23
_WORDS = 20_000  # words whose n-grams are hashed at once

# Ranges of code points (first, last) by script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x250, 0x2AF), (0x1D00, 0x1DBF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF),
              (0xAB30, 0xAB6F), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x870, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "sinhala": [(0xD80, 0xDFF)],
    "thai": [(0xE00, 0xE7F)],
    "lao": [(0xE80, 0xEFF)],
    "tibetan": [(0xF00, 0xFFF)],
    "myanmar": [(0x1000, 0x109F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)],
    "ethiopic": [(0x1200, 0x139F), (0x2D80, 0x2DDF)],
    "khmer": [(0x1780, 0x17FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
SCRIPT_NAMES = [*SCRIPTS, "other"]
_RANGES = sorted((first, last, i) for i, ranges in enumerate(SCRIPTS.values()) for first, last in ranges)
_FIRST, _LAST, _SCRIPT = (np.array(x) for x in zip(*_RANGES, strict=True))

_OTHER, _LETTER, _MARK, _NEW = range(4)
_CLASSES = np.full(0x110000, _NEW, dtype=np.uint8)


def script_of(points: np.ndarray) -> np.ndarray:
    """The script of each code point, as a place in ``SCRIPT_NAMES``."""
    at = np.maximum(np.searchsorted(_FIRST, points, side="right") - 1, 0)
    inside = (points >= _FIRST[at]) & (points <= _LAST[at])
    return np.where(inside, _SCRIPT[at], len(SCRIPTS)).astype(np.int16)


def _class_of(points: np.ndarray) -> np.ndarray:
    found = _CLASSES[points]
    if (found == _NEW).any():
        new = np.unique(points[found == _NEW])
        kinds = {"L": _LETTER, "M": _MARK}
        _CLASSES[new] = [kinds.get(unicodedata.category(chr(p))[0], _OTHER) for p in new.tolist()]
        found = _CLASSES[points]
    return found


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 bytes, and where each begins."""
    first = np.flatnonzero((data & 0xC0) != 0x80)
    points = data[first].astype(np.int64)
    wide, places = code_points(data)
    points[np.searchsorted(first, places)] = wide
    return points, first


class Words(NamedTuple):
    """The words of some texts, in order: ``at``, where each text's begin;
    ``code``, a place in the distinct words; per word its letters and the
    characters of its text before and up to its end. Per distinct word ``text``
    and ``script``."""

    at: np.ndarray
    code: np.ndarray
    letters: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: pa.Array
    script: np.ndarray


def words_of(texts: pa.Array) -> Words:
    """``texts``: a string column without nulls."""
    data, offsets = bytes_of(texts)
    points, first = characters(data)
    text_at = np.searchsorted(first, offsets)  # in characters
    kind = _class_of(points)
    script = script_of(points)
    letter = kind == _LETTER
    inside = letter | (kind == _MARK)
    # marks are of the script before them
    change = np.ones(len(points), dtype=bool)
    change[1:] = letter[1:] & (script[1:] != script[:-1]) & letter[:-1]
    new = np.zeros(len(points) + 1, dtype=bool)
    new[text_at] = True
    before = np.zeros(len(points), dtype=bool)
    before[1:] = inside[:-1]
    begins = inside & (~before | change | new[:-1])
    stops = np.zeros(len(points), dtype=bool)
    stops[:-1] = inside[:-1] & (~inside[1:] | begins[1:])
    if len(points):
        stops[-1] = inside[-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    letters_before = np.append(0, np.cumsum(letter))
    letters = letters_before[end] - letters_before[start]
    keep = letters > 0  # marks alone are no word
    start, end, letters = start[keep], end[keep], letters[keep]
    byte_at = np.append(first, len(data)).astype(np.int64)
    # words and what lies between them, alternating
    edges = np.append(np.stack([byte_at[start], byte_at[end]], axis=1).ravel(), len(data))
    both = pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges), pa.py_buffer(data))
    coded = both.take(pa.array(np.arange(0, len(edges) - 1, 2))).dictionary_encode()
    code = np.asarray(coded.indices).astype(np.int64)
    word_script = np.zeros(len(coded.dictionary), dtype=np.int16)
    # the script of the first letter: a word may begin with a mark
    at_letter = np.searchsorted(letters_before, letters_before[start], side="right") - 1
    word_script[code] = script[at_letter]
    at = np.searchsorted(start, text_at)
    row = np.repeat(np.arange(len(texts)), np.diff(at))
    base = text_at[row]
    return Words(at, code, letters, start - base, end - base, coded.dictionary, word_script)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def features(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The buckets of words' features, kind by kind: n-grams of the small-lettered
    word between two zeros, then the word as a whole. Each time all buckets and
    where each word's begin (with the end as the last)."""
    data, offsets = bytes_of(pc.utf8_lower(words))
    points, first = characters(data)
    at = np.searchsorted(first, offsets)
    sizes = np.diff(at) + 2
    ends = np.cumsum(sizes)
    padded = np.zeros(int(sizes.sum()), dtype=np.uint64)
    inner = np.ones(len(padded), dtype=bool)
    inner[ends - 1] = False
    inner[ends - sizes] = False
    padded[inner] = points
    left = np.repeat(ends, sizes) - np.arange(len(padded))  # characters to the word's end
    code = np.zeros(len(padded), dtype=np.uint64)
    for order in ORDERS:
        shifted = np.zeros(len(padded), dtype=np.uint64)
        shifted[: len(padded) - order + 1] = padded[order - 1 :]
        code = code * np.uint64(0x9E3779B97F4A7C15) + shifted + np.uint64(order)
        fits = left >= order
        yield (_mixed(code[fits]) % np.uint64(BUCKETS)).astype(np.int64), np.append(0, np.cumsum(np.maximum(sizes - order + 1, 0)))
    powers = np.cumprod(np.full(int(sizes.max(initial=1)), 0x2545F4914F6CDD1D, dtype=np.uint64))
    spread = padded * powers[(sizes.repeat(sizes) - left)]
    sums = np.append(np.uint64(0), np.cumsum(spread, dtype=np.uint64))
    whole = _mixed(sums[ends] - sums[ends - sizes] + np.uint64(99))
    yield (whole % np.uint64(BUCKETS)).astype(np.int64), np.arange(len(words) + 1)


# ------------------------------------------------------------------------------ learning

_COUNTS = "lang string, script boolean, slot int, n bigint"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language: n-gram buckets and scripts, counted over the whole task."""
    grams: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = column_of(batch, "lang"), column_of(batch, "text")
        for lang in pc.unique(langs).to_pylist():
            g = grams.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            s = scripts.setdefault(lang, np.zeros(len(SCRIPT_NAMES), dtype=np.int64))
            for part in blocks_of(texts.filter(pc.equal(langs, lang)), _BLOCK_BYTES):
                words = words_of(part)
                times = np.bincount(words.code, minlength=len(words.text))
                s += np.bincount(
                    words.script[words.code], weights=words.letters, minlength=len(SCRIPT_NAMES)
                ).astype(np.int64)
                for at in range(0, len(words.text), _WORDS):
                    some = times[at : at + _WORDS]
                    for buckets, ends in features(words.text.slice(at, _WORDS)):
                        g += np.bincount(buckets, weights=np.repeat(some, np.diff(ends)), minlength=BUCKETS).astype(np.int64)
    for is_script, counts in ((False, grams), (True, scripts)):
        for lang, found in counts.items():
            used = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array([is_script] * len(used), pa.bool_()),
                 pa.array(used.astype(np.int32)), pa.array(found[used])],
                ["lang", "script", "slot", "n"],
            )


class Model(NamedTuple):
    """``langs`` in order; ``logp`` per bucket and language; ``uses`` per script
    and language."""

    langs: list[str]
    logp: np.ndarray
    uses: np.ndarray


def learn(rows: DataFrame) -> Model:
    """The model of labelled texts: ``text`` and ``lang``, rows without either left out."""
    labelled = rows.select(F.col("text"), F.col("lang").cast("string").alias("lang")).where(
        "text is not null and lang is not null"
    )
    counted = labelled.mapInArrow(_count, _COUNTS).groupBy("lang", "script", "slot").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(counted.column("lang").to_pylist()))
    column = pc.index_in(counted.column("lang").combine_chunks(), pa.array(langs, pa.string())).to_numpy(zero_copy_only=False)
    slot, n = counted.column("slot").to_numpy(), counted.column("n").to_numpy()
    script = counted.column("script").to_numpy()
    grams = np.zeros((BUCKETS, len(langs)))
    grams[slot[~script], column[~script]] = n[~script]
    letters = np.zeros((len(SCRIPT_NAMES), len(langs)))
    letters[slot[script], column[script]] = n[script]
    logp = np.log(grams + SMOOTH) - np.log(grams.sum(axis=0) + SMOOTH * BUCKETS)
    uses = (letters > 0) & (letters >= SCRIPT_SHARE * letters.sum(axis=0))
    return Model(langs, logp.astype(np.float32), uses)


# ----------------------------------------------------------------------------- labelling


def word_scores(words: pa.Array, scripts: np.ndarray, model: Model) -> np.ndarray:
    """Per distinct word and language a score of 0 for the best candidate and less
    for the others, all 0 where the script leaves no candidate."""
    out = np.zeros((len(words), len(model.langs)), dtype=np.float32)
    for at in range(0, len(words), _WORDS):
        part = np.zeros((min(_WORDS, len(words) - at), len(model.langs)))
        for buckets, ends in features(words.slice(at, _WORDS)):
            sums = np.zeros((len(buckets) + 1, len(model.langs)))
            np.cumsum(model.logp[buckets], axis=0, out=sums[1:], dtype=np.float64)
            part += sums[ends[1:]] - sums[ends[:-1]]
        part /= len(ORDERS)  # the same letters count in each order
        candidates = model.uses[scripts[at : at + _WORDS]]
        part -= np.where(candidates, part, -np.inf).max(axis=1, initial=-1e30)[:, None]
        part = np.where(candidates, np.maximum(part, -WORST), -WORST - SWITCH)
        part[~candidates.any(axis=1)] = 0
        out[at : at + _WORDS] = part
    return out


def viterbi(scores: np.ndarray, code: np.ndarray, at: np.ndarray, switch: float = SWITCH) -> tuple[np.ndarray, np.ndarray]:
    """The best labels of all words of some texts, and each text's path score.
    ``scores[code]`` are the words' scores, ``at`` where each text's words begin.
    All texts take their steps together, the longest first."""
    langs = scores.shape[1]
    lengths = np.diff(at)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = at[:-1][order], lengths[order]
    texts = int((lengths > 0).sum())
    # how many texts have a word at each step
    active = np.searchsorted(-lengths[:texts], -np.arange(int(lengths.max(initial=0))), side="left")
    back = np.empty((len(code), langs), dtype=np.uint16)
    own = np.arange(langs, dtype=np.uint16)
    value = np.zeros((texts, langs))
    for step, k in enumerate(active.tolist()):
        word = starts[:k] + step
        held = value[:k]
        if step:
            best = held.argmax(axis=1)
            other = held[np.arange(k), best] - switch
            moved = other[:, None] > held
            back[word] = np.where(moved, best[:, None], own)
            np.maximum(held, other[:, None], out=held)
        held += scores[code[word]]
    labels = np.empty(len(code), dtype=np.int64)
    state = value.argmax(axis=1)
    totals = np.zeros(len(order))
    totals[order[:texts]] = value[np.arange(texts), state]
    for step in range(len(active) - 1, -1, -1):
        k = int(active[step])
        word = starts[:k] + step
        labels[word] = state[:k]
        if step:
            state[:k] = back[word, state[:k]]
    return labels, totals


class Found(NamedTuple):
    """Per text its language (a place in the model's, or -1) and score; spans
    ``(label, start, end)`` in characters, and where each text's begin."""

    lang: np.ndarray
    score: np.ndarray
    span_at: np.ndarray
    label: np.ndarray
    start: np.ndarray
    end: np.ndarray


def identify_texts(texts: pa.Array, model: Model) -> Found:
    n, k = len(texts), len(model.langs)
    if not k:
        none = np.zeros(0, dtype=np.int64)
        return Found(np.full(n, -1), np.zeros(n), np.zeros(n + 1, dtype=np.int64), none, none, none)
    words = words_of(texts)
    scores = word_scores(words.text, words.script, model)
    labels, _ = viterbi(scores, words.code, words.at)
    row = np.repeat(np.arange(n), np.diff(words.at))
    key = row * k + labels
    letters = np.bincount(key, weights=words.letters, minlength=n * k).reshape(n, k)
    own = np.bincount(key, weights=scores[words.code, labels], minlength=n * k).reshape(n, k)
    most = letters.max(axis=1, initial=0)
    lang = np.where(letters == most[:, None], own, -np.inf).argmax(axis=1)
    lang[most == 0] = -1
    score = np.divide(most, letters.sum(axis=1), out=np.zeros(n), where=most > 0)
    change = np.ones(len(key) + 1, dtype=bool)
    change[1:-1] = key[1:] != key[:-1]
    edge = np.flatnonzero(change)
    first, last = edge[:-1], edge[1:] - 1
    return Found(lang, score, np.searchsorted(first, words.at), labels[first], words.start[first], words.end[last])


_RESULT = "doc_id bigint, held_out boolean, lang_pred string, score double, spans array<struct<lang:string,start:bigint,end:bigint>>"


def held_out(id_col: str = "doc_id", folds: int = 3, fold: int = 1):
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == fold


def identify(docs: DataFrame, model: Model, folds: int = 3, fold: int = 1) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``lang_pred``, ``score`` and
    ``spans`` (language, first character, character after the last)."""
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = broadcast.value
        names = pa.array([*learned.langs, UNKNOWN], pa.string())
        for batch in batches:
            done = 0
            for part in blocks_of(column_of(batch, "text"), _BLOCK_BYTES):
                found = identify_texts(part, learned)
                spans = pa.StructArray.from_arrays(
                    [names.take(pa.array(found.label)), pa.array(found.start), pa.array(found.end)], ["lang", "start", "end"]
                )
                lang = np.where(found.lang < 0, len(learned.langs), found.lang)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(column_of(batch, c).slice(done, len(part)) for c in ("doc_id", "held_out")),
                        names.take(pa.array(lang)),
                        pa.array(found.score),
                        pa.ListArray.from_arrays(pa.array(found.span_at.astype(np.int32)), spans),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score", "spans"],
                )
                done += len(part)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(folds=folds, fold=fold).alias("held_out"), "text")
    return rows.mapInArrow(run, _RESULT)


def identify_languages(docs: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """Learn from the labelled documents that are not held out, label all."""
    return identify(docs, learn(docs.where(~held_out(folds=folds, fold=fold))), folds, fold)
