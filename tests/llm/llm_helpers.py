import contextlib
import io
import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that the operators use inside
    "n long, sid string, node long, size long, rank int, length string, score double, `range` int, copies int, "
    "units int, target double, word string, mark int, held_out string, c int, p double, base int, `at` int, "
    "`row` string, words long, `__words` long, `__n` long, `__toxic_score` string, `__sid` string, `__id` string, "
    "`__source` int, `__size` string, `__times` int, `__row` int, `__spread` int, `a.b` int"
)
_EXTRA = [1, "s", 2, 3, 4, "l", 0.5, 6, 7, 8, 0.25, "w", 9, "h", 10, 0.75, 11, 12,
          "r", 99, 98, 97, "t", "s", "i", 96, "z", 95, 94, 93, 92]
EXTRA_NAMES = ["n", "sid", "row", "words", "__words", "__n", "__toxic_score", "__sid", "__id", "__source", "__size",
               "__times", "__row", "__spread", "a.b"]


def extras_are_kept(df):
    """Whether the columns that only look like an operator's own have their values."""
    rows = df.select(*[f"`{n}`" for n in EXTRA_NAMES]).distinct().collect()
    return {tuple(r) for r in rows} <= {(1, "s", "r", 99, 98, 97, "t", "s", "i", 96, "z", 95, 94, 93, 92)}


def prose(rng, words, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def make_docs(spark, rows):
    """``rows``: (doc_id, text, source)."""
    return spark.createDataFrame(
        [(d, t, "en", s, None if t is None else len(t), *_EXTRA) for d, t, s in rows], SCHEMA
    )


def awkward_rows(seed=5):
    """Nulls, empty and very long texts, copies, repeated rows, near copies."""
    rng = random.Random(seed)
    long_ = prose(rng, 30_000)
    base = prose(rng, 120)
    rows = [
        (0, None, "a"), (1, "", "a"), (2, " \t\n\x0b\x0c\r ", None), (3, long_, "b"), (4, long_ + " tail", "b"),
        (5, base, "a"), (6, base.upper(), "c"), (7, base + " one more", "a"), (7, base + " one more", "a"),
        (8, "one two", None), (9, "One  TWO", "b"), (10, "one", "a"), (None, base, "a"), (None, None, None),
        (11, "a b c d e", "c"), (12, "a b c d e f", "c"), (13, "Äpfel äpfel İ   x y", "d"),
        (14, "x" * 200_000, "d"),
    ]
    for i in range(40):
        rows.append((100 + i, prose(rng, rng.randrange(1, 90)), rng.choice(["a", "a", "b", "é"])))
    return rows


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()
