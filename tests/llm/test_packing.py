import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cairn.llm.packing import Packer, SumOfSquares, encoder, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "a", "It's  two  spaces\n\n and lines \t x", "naïve café Straße", "漢字 かな 😀 ok", "x" * 5000, " lead", "trail ", "a b  c",
    "don't we'll 12 34 a_b $$$ %%%", "word " * 4000, "<|endoftext|>", "\x1c a\x1fb", "é ʰ ǅ",
]


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def test_ids_equal_the_tokenizers(tokenizer):
    for text in filter(None, TEXTS):
        ids = np.frombuffer(encoder(PATH).encode(text), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_every_id_lies_in_one_piece(docs, tokenizer):
    rows = list(enumerate(TEXTS * 4))
    pieces = pack(docs(*rows), PATH).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        mine = sorted(by_doc[i], key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in mine) == np.array(ids, "<u4").tobytes()
        assert [p.start for p in mine] == np.cumsum([0, *[p.length for p in mine]])[:-1].tolist()
        assert {p.doc_tokens for p in mine} == {len(ids)}
        assert all(zlib.crc32(bytes(p.ids)) == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes()) for p in mine)
    for sequence in by_sequence.values():
        sequence.sort(key=lambda p: p.offset)
        assert [p.offset for p in sequence] == np.cumsum([0, *[p.length for p in sequence]])[:-1].tolist()
        total = sum(p.length for p in sequence)
        assert total <= 2048 and {p.filled for p in sequence} == {total}
        assert sequence[0].padded_length == (total if total & (total - 1) == 0 else 2048)


def test_place_minimises_the_sum_of_squares():
    rng = np.random.default_rng(1)
    sums, counts = SumOfSquares(20), [0] * 21
    fill, made = {}, 0
    for size in rng.integers(1, 20, 400).tolist():
        def cost(level):
            after = list(counts)
            if level:
                after[level] -= 1
            if level + size < 20:
                after[level + size] += 1
            return sum(c * c for c in after[1:20])

        options = [h for h in range(0, 21 - size) if h == 0 or counts[h]]
        least = min(cost(h) for h in options)
        window = sums.place(size)
        level = fill.pop(window) if window is not None else 0
        assert cost(level) == least
        if level:
            counts[level] -= 1
        if level + size < 20:
            counts[level + size] += 1
            made += 1
            fill[made] = level + size
            sums.opened(made, level + size)
        assert sums.levels[1:20].tolist() == counts[1:20]


def test_drain_leaves_one_partial_window():
    packer = Packer(10, 3)
    windows = []
    for k, n in enumerate([7, 7, 7, 7, 7, 3, 25, 1]):
        windows += list(packer.add(k, np.arange(n, dtype="<u4").tobytes()))
    windows += list(packer.drain())
    sizes = [sum(len(p[2]) for p in w) // 4 for w in windows]
    assert sum(sizes) == 64 and sum(s < 10 for s in sizes) <= 1


def test_empty_table_and_null_id(docs):
    assert pack(docs(), PATH).count() == 0
    assert [(p.doc_id, p.length) for p in pack(docs((None, None)), PATH).collect()] == [(None, 1)]


def test_more_open_windows_than_allowed_lose_nothing():
    rng = np.random.default_rng(2)
    packer, windows, want = Packer(64, 5), [], {}
    for k, n in enumerate(rng.integers(1, 200, 300).tolist()):
        want[k] = rng.integers(0, 2**31, n).astype("<u4").tobytes()
        windows += list(packer.add(k, want[k]))
        assert len(packer.windows) <= 6
    windows += list(packer.drain())
    pieces = defaultdict(list)
    for window in windows:
        assert sum(len(p[2]) for p in window) // 4 <= 64
        for doc, start, ids, n in window:
            assert n == len(want[doc]) // 4
            pieces[doc].append((start, ids))
    assert {doc: b"".join(ids for _, ids in sorted(found)) for doc, found in pieces.items()} == want


def test_repeated_rows_and_clashing_names(spark):
    shape = "doc_id long, text string, doc long, start long, length string, ids binary, sequence_id string, filled long, `offset` long"
    rows = [(1, "a b c", 1, 2, "x", b"x", "s", 3, 4)] * 3 + [(None, "long " * 3000, 1, 2, "x", b"x", "s", 3, 4)]
    found = pack(spark.createDataFrame(rows, shape), PATH, most_open=1).collect()
    by_sequence = defaultdict(int)
    for p in found:
        by_sequence[p.sequence_id] += p.length
    assert sum(p.length for p in found if p.doc_id == 1) == 3 * found[0].doc_tokens or found[0].doc_id is None
    assert sum(p.length for p in found if p.doc_id is None) == next(p.doc_tokens for p in found if p.doc_id is None)
    assert all(n <= 2048 for n in by_sequence.values())
