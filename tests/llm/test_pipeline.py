import os
import random
import sys

from llm_helpers import awkward_rows, extras_are_kept, make_docs, prose

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)


def write_tables(spark, folder):
    rng = random.Random(8)
    clean = [prose(rng, rng.randrange(20, 120)) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(1000 + i, clean[i].upper()) for i in range(40)]  # copies but for case
    rows += [(2000 + i, clean[i] + " tail") for i in range(40, 80)]  # near copies of longer ones
    rows += [(3000 + i, prose(rng, 30) + " idiot scum " + prose(rng, 10) + " idiot") for i in range(120)]
    docs = spark.createDataFrame(
        [(d, t, "en", f"s{d % 3}", len(t)) for d, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    docs.repartition(4).write.parquet(f"{folder}/documents.parquet")
    labels = [(d, 1, int(d >= 3000)) for d, _ in rows if d % 2 == 0]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return dict(rows)


def test_stages_and_run(spark, tmp):
    import corpus_pipeline

    texts = write_tables(spark, tmp)
    docs = spark.read.parquet(f"{tmp}/documents.parquet")
    columns = docs.columns
    seen = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, tmp).write.parquet(f"{tmp}/{i}")
        docs = spark.read.parquet(f"{tmp}/{i}")
        seen.append(docs)
        if i < 4:
            assert docs.columns == columns, name
            assert all(r.text == texts[r.doc_id] and r.n_chars == len(r.text) for r in docs.collect())
    toxic, exact, near, mixed, packed = seen
    left = {r.doc_id for r in toxic.collect()}
    assert left == {d for d in texts if d < 3000}
    left = {r.doc_id for r in exact.collect()}
    assert left == {d for d in texts if d < 3000 and not d < 40}
    kept = {r.doc_id for r in near.collect()}
    assert kept <= left and {d for d in left if d >= 1000 and d < 2000} <= kept
    for i in range(40, 80):
        n = len(texts[i].split()) - 4
        assert (2000 + i not in kept) == (100 * n >= 80 * (n + 1)) and i in kept
    counts = {}
    for r in mixed.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert set(counts) <= kept and max(counts.values()) <= 2
    words = sum(len(texts[d].split()) * k for d, k in counts.items())
    assert abs(words / (1.5 * sum(len(texts[d].split()) for d in kept)) - 1) < 0.02
    assert sum(r.length == r.doc_tokens or r.start == 0 for r in packed.collect()) == sum(counts.values())

    again = corpus_pipeline.run(spark, tmp)
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in again.collect()) == sorted(
        (r.doc_id, r.start, r.ids_crc32) for r in packed.collect()
    )


def write_awkward(spark, folder, rows):
    docs = make_docs(spark, rows)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(d, 1, d % 2) for d, _, _ in rows if d is not None and d < 130] + [(None, 0, None), (5, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs


def test_awkward_rows_and_clashing_names(spark, tmp):
    import corpus_pipeline

    rows = awkward_rows()
    docs = write_awkward(spark, tmp, rows)
    columns, texts = docs.columns, {(d, t) for d, t, _ in rows}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = docs.count()
        stage(spark, docs, tmp).write.parquet(f"{tmp}/{i}")
        docs = spark.read.parquet(f"{tmp}/{i}")
        assert docs.columns == columns, name
        assert extras_are_kept(docs), name
        assert {(r.doc_id, r.text) for r in docs.collect()} <= texts, name
        assert docs.count() <= before or name == "mixing sources"
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, tmp)
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
    assert packed.where("start = 0").count() == docs.count()


def test_empty_tables(spark, tmp):
    import corpus_pipeline

    write_awkward(spark, tmp, [])
    assert corpus_pipeline.run(spark, tmp).count() == 0
