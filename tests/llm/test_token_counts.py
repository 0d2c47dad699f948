"""Counts against plain longest match and against a library's word pieces."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from larder.llm import token_counts
from larder.llm.token_counts import Automaton


def greedy(word, first, rest):
    n, at = 0, 0
    while at < len(word):
        pieces = rest if at else first
        size = max((k for k in range(1, len(word) - at + 1) if word[at:at + k] in pieces), default=0)
        if not size:
            return 1
        at, n = at + size, n + 1
    return n


@pytest.mark.parametrize("seed", range(20))
def test_random_pieces(seed):
    rng = random.Random(seed)
    make = lambda n, most: {bytes(rng.choices(b"abc", k=rng.randint(1, most))) for _ in range(n)}
    first, rest = make(8, 5), make(12, 6)
    if seed % 2:
        first |= {b"a", b"b", b"c"}
        rest |= {b"a", b"b", b"c"}
    automaton = Automaton(first, rest)
    words = [bytes(rng.choices(b"abcd" if seed % 5 == 0 else b"abc", k=rng.choice([0, 1, 2, 5, 9, 30, 300]))) for _ in range(300)]
    assert automaton.count_all(words).tolist() == [greedy(w, first, rest) for w in words]
    assert [automaton.count(w) for w in words] == [greedy(w, first, rest) for w in words]


def test_library_pieces():
    rng = random.Random(9)
    pieces = {"".join(rng.choices("abcde", k=rng.randint(1, 4))) for _ in range(60)}
    vocabulary = {p: i for i, p in enumerate(["[UNK]", *sorted(pieces), *("##" + p for p in sorted(pieces))])}
    library = Tokenizer(models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=10_000))
    library.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    words = ["".join(rng.choices("abcdef", k=rng.randint(1, 20))) for _ in range(2000)]
    automaton = Automaton([p.encode() for p in pieces], [p.encode() for p in pieces])
    assert automaton.count_all([w.encode() for w in words]).tolist() == [len(library.encode(w).ids) for w in words]


def test_query(spark, documents, write):
    texts = [None, "", " \n\t", "the theory of  everything\n", "é 中文 😀", "x" * 5000, "the theory of  everything\n"]
    rows = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts.op2_token_counts(spark, write(documents=documents(*texts))).collect()}
    automaton = token_counts.from_byte_bpe(public_tokenizers.path(token_counts.VOCABULARY))
    want = {i: (len((t or "").encode().split()), sum(map(automaton.count, (t or "").encode().split()))) for i, t in enumerate(texts)}
    assert rows == want and rows[3][1] >= 4 and rows[0] == rows[1] == rows[2] == (0, 0)
    assert token_counts.counted(documents("a").where("false").selectExpr("*", "1 as n_words")).collect() == []
