import itertools
import random
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import awkward_rows, make_docs

from quarry.llm import language
from quarry.llm.language import (
    SCRIPT_NAMES,
    Model,
    features,
    identify,
    identify_languages,
    identify_texts,
    learn,
    script_of,
    viterbi,
    word_scores,
    words_of,
)

SYLLABLES = {
    "en": ["th", "ing", "er", "on", "wh", "ly", "ed", "sh"],
    "de": ["sch", "ung", "keit", "ü", "pf", "ver", "ein", "zu"],
    "fr": ["eau", "oi", "é", "que", "ou", "ç", "è", "ment"],
    "ru": ["при", "ст", "ова", "ние", "ть", "ск", "ый", "ого"],
    "uk": ["ії", "ськ", "ння", "єт", "ого", "ти", "ць", "при"],
}


def text_in(lang, rng, words):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(2, 5))) for _ in range(words))


def labelled(spark, seed=1, each=60):
    rng = random.Random(seed)
    rows = [(text_in(lang, rng, rng.randrange(20, 80)), lang) for lang in SYLLABLES for _ in range(each)]
    return spark.createDataFrame(rows, "text string, lang string")


# ---------------------------------------------------------------------------- words


def plain_words(text):
    """(start, end, script) character by character."""
    out, at = [], None
    script = None
    scripts = script_of(np.array([ord(c) for c in text], dtype=np.int64)).tolist()

    def close(end):
        if at is not None and any(unicodedata.category(c)[0] == "L" for c in text[at:end]):
            out.append((at, end))

    for i, c in enumerate(text):
        kind = unicodedata.category(c)[0]
        if kind == "L" and (at is None or (unicodedata.category(text[i - 1])[0] == "L" and scripts[i] != script)):
            close(i)
            at = i
        elif kind == "M" and at is None:
            at = i
        elif kind not in "LM":
            close(i)
            at = None
        script = scripts[i]
    close(len(text))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é́ßЖи日かカ한ا्कक 1.\n👍"), max_size=30), max_size=6))
def test_words(texts):
    found = words_of(pa.array(texts, pa.string()))
    spans = list(zip(found.start.tolist(), found.end.tolist(), strict=True))
    for i, text in enumerate(texts):
        a, b = found.at[i], found.at[i + 1]
        assert spans[a:b] == plain_words(text)
        for j in range(a, b):
            word = text[slice(*spans[j])]
            assert found.text[int(found.code[j])].as_py() == word
            assert found.letters[j] == sum(unicodedata.category(c)[0] == "L" for c in word)


def test_scripts():
    points = np.array([ord(c) for c in "aßéЖΩ日かア한א1 क"], dtype=np.int64)
    names = [SCRIPT_NAMES[i] for i in script_of(points)]
    assert names == ["latin"] * 3 + ["cyrillic", "greek", "han", "kana", "kana", "hangul", "hebrew", "other", "other", "devanagari"]


def test_features_are_the_same_for_small_and_capital_letters_and_any_place():
    words = ["Abc", "x", "überaus", "abc", "ÜBERAUS", "日本"]
    together = [
        [buckets[a:b].tolist() for a, b in itertools.pairwise(ends.tolist())]
        for buckets, ends in features(pa.array(words, pa.large_string()))
    ]
    assert [len(x) for x in (kind[0] for kind in together)] == [5, 4, 3, 2, 1]
    for i, w in enumerate(words):
        alone = [buckets.tolist() for buckets, _ in features(pa.array([w], pa.large_string()))]
        assert alone == [kind[i] for kind in together]
    for kind in together:
        assert kind[0] == kind[3] and kind[2] == kind[4] and kind[0] != kind[5]


# -------------------------------------------------------------------------- the path


def best_by_trying(scores, switch):
    n, langs = scores.shape
    return max(
        sum(scores[i, p] for i, p in enumerate(path)) - switch * sum(a != b for a, b in itertools.pairwise(path))
        for path in itertools.product(range(langs), repeat=n)
    )


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(3)
    for _ in range(30):
        langs = int(rng.integers(1, 4))
        lengths = rng.integers(0, 7, size=int(rng.integers(0, 6)))
        at = np.append(0, np.cumsum(lengths)).astype(np.int64)
        scores = -rng.integers(0, 9, size=(20, langs)).astype(np.float32)
        code = rng.integers(0, 20, size=int(at[-1]))
        labels, totals = viterbi(scores, code, at, switch=3.0)
        for i, (a, b) in enumerate(itertools.pairwise(at.tolist())):
            if a == b:
                assert totals[i] == 0
                continue
            own = scores[code[a:b]]
            path = labels[a:b]
            value = own[np.arange(b - a), path].sum() - 3.0 * (path[1:] != path[:-1]).sum()
            assert value == totals[i] == best_by_trying(own, 3.0)


def test_the_penalty_keeps_single_words_in_their_span():
    scores = np.array([[0, -5], [-5, 0]], dtype=np.float32)
    at = np.array([0, 5])
    code = np.array([0, 0, 1, 0, 0])
    assert viterbi(scores, code, at, switch=8.0)[0].tolist() == [0] * 5
    assert viterbi(scores, code, at, switch=1.0)[0].tolist() == [0, 0, 1, 0, 0]


# ------------------------------------------------------------------------ whole texts


def test_held_out_texts_and_spans(spark):
    model = learn(labelled(spark).repartition(4))
    assert model.langs == sorted(SYLLABLES)
    rng = random.Random(9)
    langs = [lang for lang in SYLLABLES for _ in range(40)]
    found = identify_texts(pa.array([text_in(lang, rng, 30) for lang in langs]), model)
    assert np.mean([model.langs[i] == lang for i, lang in zip(found.lang, langs, strict=True)]) >= 0.99
    mixed = [text_in("de", rng, 25), text_in("en", rng, 40), text_in("ru", rng, 10)]
    found = identify_texts(pa.array([". ".join(mixed)]), model)
    assert [model.langs[i] for i in found.label] == ["de", "en", "ru"]
    cuts = np.cumsum([len(x) + 2 for x in mixed])
    assert abs(found.end[0] - cuts[0]) < 25 and abs(found.end[1] - cuts[1]) < 25
    assert model.langs[found.lang[0]] == "en" and 0.3 < found.score[0] < 0.8


def test_scripts_narrow_the_candidates(spark):
    model = learn(labelled(spark))
    words = words_of(pa.array(["прист theing 日本"]))
    scores = word_scores(words.text, words.script, model)
    for i, word in enumerate(words.text.to_pylist()):
        left = {lang for lang, s in zip(model.langs, scores[i], strict=True) if s > -language.WORST - 1}
        assert left == ({"ru", "uk"} if word == "прист" else {"de", "en", "fr"} if word == "theing" else set(SYLLABLES))
    # no language uses the script: some learned language all the same
    found = identify_texts(pa.array(["日本", "日本 theingsh theed"]), model)
    assert found.lang[0] >= 0 and model.langs[found.lang[1]] == "en"


def test_blocks_and_partitions_change_nothing(spark, monkeypatch):
    rows = [(i, t, "s") for i, (t, _) in enumerate(map(tuple, labelled(spark, 5, 20).collect()))]
    rows += [(1000, " ".join(t for _, t, _ in rows) * 20, "s"), (1001, None, "s")]
    docs = make_docs(spark, rows)
    model = learn(labelled(spark))
    want = sorted(map(repr, identify(docs.coalesce(1), model).collect()))
    monkeypatch.setattr(language, "_BLOCK_BYTES", 3000)
    monkeypatch.setattr(language, "_WORDS", 7)
    assert sorted(map(repr, identify(docs.repartition(5), model).collect())) == want
    assert np.array_equal(learn(labelled(spark).repartition(7)).logp, model.logp)


def test_awkward_rows(spark, awkward):
    rows = awkward_rows()
    got = identify_languages(awkward).collect()
    assert len(got) == len(rows)
    letters = {d: any(unicodedata.category(c)[0] == "L" for c in t or "") for d, t, _ in rows}
    for r in got:
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == (zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 3 == 1)
        if r["doc_id"] is not None:
            assert r["lang_pred"] == ("en" if letters[r["doc_id"]] else "und")
            assert bool(r["spans"]) == letters[r["doc_id"]]


def test_labels_of_held_out_rows_are_not_learned(spark):
    rng = random.Random(2)
    rows = [(i, text_in("en" if i % 2 else "de", rng, 30), "x" if zlib.crc32(str(i).encode()) % 3 == 1 else "en" if i % 2 else "de")
            for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = identify_languages(docs).collect()
    assert {r["lang_pred"] for r in got} == {"en", "de"}
    assert all(r["lang_pred"] == ("en" if r["doc_id"] % 2 else "de") for r in got)


def test_nothing_learned_and_no_documents(spark, no_docs):
    assert identify_languages(no_docs).count() == 0
    docs = spark.createDataFrame([(1, "abc def", None), (2, None, "en")], "doc_id long, text string, lang string")
    got = identify_languages(docs).collect()
    assert [(r["lang_pred"], r["score"], r["spans"]) for r in got] == [("und", 0.0, []), ("und", 0.0, [])]
    empty = Model([], np.zeros((language.BUCKETS, 0)), np.zeros((len(SCRIPT_NAMES), 0), dtype=bool))
    assert identify_texts(pa.array(["a b"]), empty).lang.tolist() == [-1]
