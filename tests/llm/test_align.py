import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import awkward_rows, make_docs, prose
from test_tokens import odd_texts
from tokenizers import Tokenizer

from quarry.llm import align as module
from quarry.llm.align import Block, align, align_documents, aligned_groups, jump_to_last
from quarry.llm.queries import BYTE_BPE, PIECE_BPE
from quarry.llm.tokens import byte_letters

TOKENIZER = Tokenizer.from_file(BYTE_BPE)
TOKENIZER.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
BACK = {c: b for b, c in byte_letters().items()}


def plainly(text):
    """Groups, and links as id pairs, token by token."""
    if not text:
        return [], []
    a = TOKENIZER.encode(" " + text, add_special_tokens=False).ids
    b = PIECES.encode(text)
    a_bytes = [bytes(BACK[c] for c in TOKENIZER.id_to_token(i)) for i in a]
    b_bytes = [
        bytes([int(PIECES.id_to_piece(i)[1:-1], 16)]) if PIECES.is_byte(i) else PIECES.id_to_piece(i).replace("▁", " ").encode()
        for i in b
    ]
    raw = (" " + text).encode()
    if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return [], []
    a_ends, b_ends = (np.cumsum([len(x) for x in y]).tolist() for y in (a_bytes, b_bytes))
    groups, links, i, j = [], [], 0, 0
    for cut in sorted(set(a_ends) & set(b_ends)):
        i0, j0 = i, j
        while i < len(a) and a_ends[i] <= cut:
            i += 1
        while j < len(b) and b_ends[j] <= cut:
            j += 1
        groups.append((a[i0:i], b[j0:j]))
        p, q = i0, j0
        while p < i and q < j:
            links.append((a[p], b[q]))
            after = min(a_ends[p], b_ends[q])
            p, q = p + (a_ends[p] == after), q + (b_ends[q] == after)
    return groups, links


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def expected(rows):
    found = {i: plainly(t) for i, (_, t, _) in enumerate(rows)}
    counts = Counter(x for _, links in found.values() for x in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for i, (doc_id, _, _) in enumerate(rows):
        groups, links = found[i]
        out.append((
            doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(written(groups).encode()).hexdigest() if groups else "",
        ))
    return sorted(map(repr, out))


FIXED = [
    "a▁b", "x ▁ y", "a\0b", "<0x41> <s> </s> <unk> <|endoftext|>", "᠎ a", " ", "  ", "﻿a", "a ", "　 x",
    "日本  語", "\n a\n", "ﬁ ½ Å",
]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=40), st.randoms())
def test_pointer_jumping_finds_the_common_cuts(sizes, rng):
    a = np.cumsum(sizes, dtype=np.int64)
    total = int(a[-1]) if len(a) else 0
    b = np.array(sorted({rng.randrange(1, total + 1) for _ in range(rng.randrange(40))} | {total}) if total else [], dtype=np.int64)
    found = align(a, b)
    cuts = sorted(set(a.tolist()) & set(b.tolist()))
    assert found.ends.tolist() == cuts
    assert found.a_label.tolist() == np.searchsorted(cuts, a).tolist()
    assert found.b_label.tolist() == np.searchsorted(cuts, b).tolist()
    begin = lambda ends, i: int(ends[i - 1]) if i else 0
    links = {
        (i, j) for i in range(len(a)) for j in range(len(b)) if max(begin(a, i), begin(b, j)) < min(a[i], b[j])
    }
    assert sorted(zip(*map(np.ndarray.tolist, found.links), strict=True)) == sorted(links)


def test_a_chain_of_any_length_ends_at_its_last_token():
    n = 100_000  # tokens of two bytes, and the same shifted by one
    a = np.append(np.arange(2, 2 * n + 1, 2), 2 * n + 1)
    b = np.arange(1, 2 * n + 2, 2)
    found = align(a, b)
    assert found.ends.tolist() == [2 * n + 1] and not found.a_label.any() and not found.b_label.any()
    assert jump_to_last(np.array([1, 2, 2])).tolist() == [2, 2, 2]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_blocks_of_odd_texts(kind):
    texts = [*odd_texts(1500), *FIXED, None, prose(random.Random(2), 300) + ".\nEinch ß"]
    block = Block(pa.array(texts, kind), BYTE_BPE, PIECE_BPE)
    groups = [g.decode() for g in block.groups()]
    for i, text in enumerate(texts):
        want, links = plainly(text)
        assert groups[i] == written(want), repr(text)
        assert block.counts["n_links"][i] == len(links)


def rows_of_all_kinds():
    rng = random.Random(11)
    rows = awkward_rows() + [(500 + i, t, "a") for i, t in enumerate(FIXED)]
    return rows + [(600 + i, prose(rng, 50, 30).replace("w1", "é "), "b") for i in range(60)] + [(700, "y" * 300_000, "b")]


@pytest.mark.parametrize("size", [1, 50_000, module.BLOCK_BYTES])
def test_documents_against_brute_force(spark, monkeypatch, size):
    rows = rows_of_all_kinds()
    if size == 1:  # each text a block of its own
        monkeypatch.setattr(module, "BLOCK_BYTES", 1)
        rows = rows[5:40]
    docs = make_docs(spark, rows).repartition(3)
    if size == 50_000:
        monkeypatch.setattr(module, "BLOCK_BYTES", size)
    got = align_documents(docs, BYTE_BPE, PIECE_BPE)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got.columns == names
    assert sorted(map(repr, map(tuple, got.collect()))) == expected(rows)


def test_groups_as_text(spark):
    rows = rows_of_all_kinds()[:40]
    got = aligned_groups(make_docs(spark, rows), BYTE_BPE, PIECE_BPE).select("doc_id", "groups").collect()
    want = [(d, written(plainly(t)[0])) for d, t, _ in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_no_documents(spark, no_docs):
    assert align_documents(no_docs, BYTE_BPE, PIECE_BPE).count() == 0


def test_arrays_of_a_block_in_many_rows(spark, monkeypatch):
    """Also blocks without a token."""
    rows = rows_of_all_kinds()
    monkeypatch.setattr(module, "_PART_BYTES", 64)
    monkeypatch.setattr(module, "_SEGMENT_BYTES", 50)
    monkeypatch.setattr(module, "_CUT_BYTES", 7)
    monkeypatch.setattr(module, "_JOINED", 3)
    got = align_documents(make_docs(spark, rows).repartition(2), BYTE_BPE, PIECE_BPE)
    assert sorted(map(repr, map(tuple, got.collect()))) == expected(rows)
    none = [(1, None, "a"), (2, "", "a"), (3, "a▁b", "b")]
    got = align_documents(make_docs(spark, none).coalesce(1), BYTE_BPE, PIECE_BPE)
    assert sorted(map(repr, map(tuple, got.collect()))) == expected(none)


def test_rows_of_blocks_are_small(monkeypatch):
    """However much text a block has: executors hold several such rows at once."""
    rng = random.Random(5)
    texts = [" ".join(f"{rng.randrange(10**6):x}" for _ in range(1000)) for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    task = type("Task", (), {"get": staticmethod(lambda: type("Now", (), {"partitionId": lambda self: 7})())})
    monkeypatch.setattr(module, "TaskContext", task)
    found = list(module._aligned_blocks(BYTE_BPE, PIECE_BPE)(iter([batch])))
    assert all(x.num_rows == 1 for x in found)
    assert max(x.nbytes for x in found) < 1_000_000 < sum(x.nbytes for x in found)


@pytest.mark.parametrize("each", [1, 3, 40])
def test_blocks_do_not_depend_on_batches(monkeypatch, each):
    """A batch that ends within a block begins no block of its own."""
    monkeypatch.setattr(module, "BLOCK_BYTES", 100)
    texts = ["x" * (7 + i % 5) if i % 6 else None for i in range(60)]
    table = pa.table({"doc_id": range(60), "text": pa.array(texts)})
    found = list(module._blocks(iter(table.to_batches(max_chunksize=each))))
    assert [i for ids, _ in found for i in ids.to_pylist()] == list(range(60))
    assert [t for _, some in found for t in some.to_pylist()] == texts
    sizes = [sum(len(t or "") for t in some.to_pylist()) for _, some in found]
    assert all(100 <= s < 112 for s in sizes[:-1]) and sizes[-1] < 100


def test_few_segments_are_tokenised_at_once(monkeypatch):
    """Their ids are lists of Python integers until then."""
    seen = []

    def encode(self, spaced):
        seen.append(sum(len(s.encode()) for s in spaced))
        return plain(self, spaced)

    plain = module.PieceModel.encode
    monkeypatch.setattr(module.PieceModel, "encode", encode)
    texts = pa.array([" ".join(f"{i * 7919 + j:x}" for j in range(2000)) for i in range(40)])
    Block(texts, BYTE_BPE, PIECE_BPE)
    assert sum(seen) > 300_000 and max(seen) <= 1 << 17
