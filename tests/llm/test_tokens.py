import random
import sys
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_helpers import awkward_rows, make_docs, prose
from tokenizers import Tokenizer

from quarry.llm import packing, tokens
from quarry.llm.common import BATCH_BYTES, BATCH_CONF, small_batches
from quarry.llm.packing import pack_documents, pack_histogram, pack_ids, unpack_ids, with_checksum
from quarry.llm.queries import BYTE_BPE, WORD_BPE
from quarry.llm.token_file import decode_ranks, encode_ranks, read_tokens, write_tokens
from quarry.llm.token_file import with_checksum as token_checksum
from quarry.llm.tokens import Encoder


def whole_ids(path, texts, special=True):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = not special
    return [np.array(e.ids, dtype="<u4") for e in t.encode_batch(texts, add_special_tokens=False)]


def odd_texts(count=3000):
    rng = random.Random(7)
    letters = list("abAB ,.!'\n\té1²İ́ \u3000   x\x1c\x0b\x85\xa0") + ["'s", "'re", "'LL", "<|endoftext|>"]
    fixed = [
        "", " ", "  a  b ", "\n x\n y \n", "it's we're 's x", "IT'S we'RE 'S", "x,'s ''t 's's'll'", "İ Σ ς ΑΣ b",
        "á b́ c", "x\x1cy z \x85 w", "<|endoftext|> a <|startoftext|>", "1,2 3. 4x, ,, ..",
        "日本語 テキスト、 です。 ok", "👍🏽 a 👍 b", "a ", "²³, x² a²,", "K \u212a ſ 'ſ", "각 각", "«a» — „b“", "ǅ ẞ ß",
        "a  \n\n  b\n\nc   \n", "🫨 ꟑ \U00031350", "word " * 40_000,
    ]
    return fixed + ["".join(rng.choices(letters, k=rng.randrange(30))) for _ in range(count)]


def test_special_strings_get_the_ids_of_the_library():
    assert [x.tolist() for x in whole_ids(BYTE_BPE, ["a<|endoftext|>"])] == [[64, 50256]]
    assert [x.tolist() for x in Encoder(BYTE_BPE).encode_all(pa.array(["a<|endoftext|>"]))] == [[64, 50256, 1]]


@pytest.mark.parametrize("special", [True, False])
@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_pieces_give_the_ids_of_the_whole_text(path, special, monkeypatch):
    texts = odd_texts() + [prose(random.Random(i), 200) + "." for i in range(50)]
    want = [x.tolist() for x in whole_ids(path, texts, special)]

    def found():
        ids, offsets = Encoder(path, special).encode(pa.array(texts))
        return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]

    assert found() == want
    monkeypatch.setattr(tokens, "_PIECES", 300)  # forgets pieces all the time
    monkeypatch.setattr(tokens, "_BLOCK_BYTES", 500)
    assert found() == want


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_texts_are_cut_in_parts(path, monkeypatch):
    texts = odd_texts()
    want = [x.tolist() for x in whole_ids(path, texts)]
    for size in (1, 50, 5000):
        monkeypatch.setattr(tokens, "_CUT_BYTES", size)
        monkeypatch.setattr(tokens, "_GATHERED", size)
        ids, offsets = Encoder(path).encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == want


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_encoding_takes_little_memory(path):
    texts = pa.array([prose(random.Random(i), 500) for i in range(800)])
    encoder = Encoder(path)
    encoder.encode(texts)
    tracemalloc.start()
    encoder.encode(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 18 * texts.nbytes


def test_texts_are_encoded_from_small_batches(spark, monkeypatch):
    spark.conf.unset(BATCH_CONF)
    set_at = {}

    def stage(df, name):
        set_at[name] = spark.conf.get(BATCH_CONF, None)
        return real(df, name)

    real = packing.stage
    monkeypatch.setattr(packing, "stage", stage)
    docs = make_docs(spark, [(i, "a b " * 2000, "s") for i in range(1500)]).coalesce(1)
    assert pack_documents(docs, BYTE_BPE).count() > 1500
    assert set_at["pieces"] == str(BATCH_BYTES) and spark.conf.get(BATCH_CONF, None) is None

    def sizes(batches):
        return (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)

    def largest():
        return max(r.n for r in docs.select("text").mapInArrow(sizes, "n bigint").collect())

    assert largest() > 2 * BATCH_BYTES
    with small_batches(spark):
        assert largest() < 1.2 * BATCH_BYTES
    spark.conf.set(BATCH_CONF, "1000000")
    try:
        with small_batches(spark):
            assert spark.conf.get(BATCH_CONF) == "1000000"
        assert spark.conf.get(BATCH_CONF) == "1000000"
    finally:
        spark.conf.unset(BATCH_CONF)


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_no_python_work_per_piece(path):
    column = pa.array([" ".join(f"w{i}é{j}q" for j in range(1000)) for i in range(20)])
    found, calls = Encoder(path), []
    sys.setprofile(lambda frame, event, arg: calls.append(1) if event in ("call", "c_call") else None)
    try:
        ids, offsets = found.encode(column)
    finally:
        sys.setprofile(None)
    assert len(calls) < 5000  # 20,000 pieces that were not met before
    got = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert got == [x.tolist() for x in whole_ids(path, column.to_pylist())]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_remembered_pieces_are_bounded_in_bytes(path, monkeypatch):
    monkeypatch.setattr(tokens, "_PIECE_BYTES", 5000)
    found, rng = Encoder(path), random.Random(3)
    for _ in range(6):
        texts = ["".join(rng.choices("abcdé", k=4000)) + " \u3000\u00a0Ab \u1680" for _ in range(3)]
        ids, offsets = found.encode(pa.array(texts))
        got = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        assert got == [x.tolist() for x in whole_ids(path, texts)]
        assert found._known.nbytes < 25_000


def test_the_encoder_takes_slices_nulls_and_both_string_types():
    column = pa.array([None, "a b", "", "é, c's"])
    want = [[], *(x.tolist() for x in whole_ids(BYTE_BPE, ["a b", "", "é, c's"]))]
    for kind in (pa.string(), pa.large_string()):
        for first in range(5):
            got = Encoder(BYTE_BPE).encode_all(column.cast(kind).slice(first))
            assert [x.tolist() for x in got] == [[*w, 1] for w in want[first:]]


def test_packed_ids_round_trip():
    for ids in ([], [1], [5, 65535], [5, 65536, 2**32 - 1]):
        ids = np.array(ids, dtype="<u4")
        assert unpack_ids(pack_ids(ids)).tolist() == ids.tolist()


def test_ranks_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 5, 1000):
        ranks = (2.0 ** rng.uniform(0, 32, n)).astype(np.uint32)
        control, data = encode_ranks(ranks)
        assert len(control) == -(-n // 4)
        assert decode_ranks(control, data, n).tolist() == ranks.tolist()
    edges = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], dtype=np.uint32)
    control, data = encode_ranks(edges)
    assert len(data) == 1 + 1 + 2 + 2 + 3 + 3 + 4 + 4 and decode_ranks(control, data, 8).tolist() == edges.tolist()


def sequences_of(slots, counts):
    """Sequence id -> (offset, length) of all pieces."""
    found = {}
    for length, n in counts.items():
        for s, o in zip(*slots.find(np.full(n, length), np.arange(n)), strict=True):
            found.setdefault(int(s), []).append((int(o), length))
    return found


@pytest.mark.parametrize("counts", [
    {}, {2048: 3}, {1: 5000}, {1: 1, 2047: 1}, {1000: 7, 1048: 3, 2048: 1}, {700: 100, 650: 31, 3: 900},
    {i: 1 + (i * 7919) % 5 for i in range(1, 2049)},
])
def test_packing_a_histogram(counts):
    found = sequences_of(pack_histogram(counts), counts)
    assert sum(len(v) for v in found.values()) == sum(counts.values())
    for pieces in found.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(k * n for k, n in counts.items())
    if len(counts) > 2000:
        assert total / (2048 * len(found)) > 0.995


def test_longest_first_into_the_shortest_pack():
    # 1200 and 1100 open packs; 800 goes to the shorter one, then 700 to the other
    found = sequences_of(pack_histogram({1200: 1, 1100: 1, 800: 1, 700: 1}), {1200: 1, 1100: 1, 800: 1, 700: 1})
    assert sorted(sorted(x for _, x in v) for v in found.values()) == [[700, 1200], [800, 1100]]


def check_packed(rows, got):
    texts = [t or "" for _, t, _ in rows]
    docs = {}
    for (d, _, _), ids in zip(rows, whole_ids(BYTE_BPE, texts), strict=True):
        docs.setdefault(d, []).append(np.append(ids, np.uint32(1)))
    sequences, total = {}, 0
    for r in got:
        full = next(x for x in docs[r.doc_id] if len(x) == r.doc_tokens)
        piece = full[r.start : r.start + r.length].astype("<u4")
        assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        total += r.length
    assert total == sum(len(x) for v in docs.values() for x in v)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    cover = {}
    for r in got:
        cover.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length))
    for (d, n), parts in cover.items():
        copies = sum(len(x) == n for x in docs[d])
        assert sum(x for _, x in parts) == n * copies


def test_packing_awkward_rows(awkward):
    check_packed(awkward_rows(), with_checksum(pack_documents(awkward, BYTE_BPE)).collect())


def test_packing_many_short_documents(spark):
    rows = [(i, ["", "a", "some words here"][i % 3], "s") for i in range(5000)]
    got = with_checksum(pack_documents(make_docs(spark, rows).repartition(6), BYTE_BPE)).collect()
    check_packed(rows, got)
    assert len({r.sequence_id for r in got}) == -(-sum(r.length for r in got) // 2048)


def test_packed_ids_are_the_operators_output(spark):
    docs = make_docs(spark, [(1, "some words", "s")])
    row = pack_documents(docs, BYTE_BPE).collect()[0]
    assert np.frombuffer(row.ids, "<u4").tolist() == [*whole_ids(BYTE_BPE, ["some words"])[0].tolist(), 1]


def test_token_folder_round_trip(spark, awkward, tmp):
    rows = awkward_rows()
    write_tokens(awkward.repartition(5), WORD_BPE, f"{tmp}/t")
    got = token_checksum(read_tokens(spark, f"{tmp}/t")).collect()
    want = []
    for (d, _, _), ids in zip(rows, whole_ids(WORD_BPE, [t or "" for _, t, _ in rows]), strict=True):
        full = np.append(ids, np.uint32(1)).astype("<u4")
        want.append((d, len(full), zlib.crc32(full.tobytes())))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (d is None, d or 0, n, c) for d, n, c in want
    )
    at, last = 0, None
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        assert last is None or (r.doc_id is not None and r.doc_id >= last)
        last = r.doc_id


def test_empty_tables(spark, no_docs, tmp):
    assert pack_documents(no_docs, BYTE_BPE).count() == 0
    write_tokens(no_docs, WORD_BPE, f"{tmp}/t")
    assert read_tokens(spark, f"{tmp}/t").count() == 0


def test_paths_are_those_of_the_public_files():
    assert BYTE_BPE == public_tokenizers.path("byte_bpe_50k.json")
