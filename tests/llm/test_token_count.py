import math
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models

from cairn.llm.token_count import MARK, Viterbi, count_tokens, read_vocabulary

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(PATH)


@pytest.mark.parametrize("with_bytes", [True, False])
def test_counts_equal_the_library(vocabulary, with_bytes):
    pieces, falls_back = vocabulary
    assert falls_back
    lowest = min(s for _, s in pieces)
    special = [("<unk>", lowest), *((f"<0x{b:02X}>", lowest) for b in range(256) if with_bytes)]
    library = Tokenizer(models.Unigram([*special, *pieces], 0, byte_fallback=with_bytes))
    mine = Viterbi(pieces, with_bytes)
    assert mine.by_word and mine.bytes == with_bytes
    rng = random.Random(2)
    parts = ["a", "the ", " ", "  ", "\n", "é", "漢", "龘", "😀", "<x>", "ing", MARK, "Wort", "hello", " world", "tion"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    for text in texts:
        assert mine.count(text)[0] == len(library.encode(MARK + text.replace(" ", MARK), add_special_tokens=False).ids)
    whole = Viterbi(pieces, with_bytes)
    whole.by_word = False
    assert [mine.count(t) for t in texts] == [whole.count(t) for t in texts]


def test_control_and_byte_pieces_are_text(vocabulary):
    mine = Viterbi(*vocabulary)
    assert not {"<s>", "</s>", "<unk>", "<0x41>"} & {p for p, _ in vocabulary[0]}
    assert mine.count("x<s>y")[0] == 5 and mine.count("<0x41>")[0] > 3


def test_ranks_give_the_law_of_zipf(vocabulary):
    pieces, _ = vocabulary
    scores = sorted((s for _, s in pieces), reverse=True)
    assert scores[0] - scores[9] == pytest.approx(math.log(10), abs=1e-5) and sum(math.exp(s) for s in scores) == pytest.approx(1, abs=0.01)
    assert Viterbi(*vocabulary).count("hello world")[0] == 3


def test_ties_go_to_the_earliest_start():
    tied = Viterbi([("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("c", -1.0), ("ab", -2.0), ("bc", -2.0)])
    assert tied.count_run("abc")[:2] == (2, -3.0)  # ab c, for ab comes before a b


def test_rows(docs):
    found = {r.doc_id: r for r in count_tokens(docs((1, None), (2, ""), (3, "hello world"), (4, "x" * 50_000)), PATH).collect()}
    assert found[1].n_tokens == found[2].n_tokens == 0 and found[3].n_tokens > 0 and found[4].n_tokens > 1000
    assert count_tokens(docs(), PATH).count() == 0
    assert [r.n_tokens for r in count_tokens(docs((None, "a"), (None, "a")), PATH).collect()] == [1, 1]
