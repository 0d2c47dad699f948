"""Ids and decoded texts against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from larder.llm import bpe

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(1)
    pool = [chr(rng.randrange(1, 0x2FFF)) for _ in range(300)] + list(" \n\t\x1c\x1d\x85\xa0'sdm") * 20
    pool += ["<|endoftext|>", "'ll", "😀", "  ", "a", "1", "²", "½", "ß", "中文", "　", "the", " of"] * 5
    mixed = ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(1500)]
    return [*mixed, "x՘y 1㍇ \U000323b0a", "a" * 5000, "ab" * 3000, "  " * 999, "!" * 777, "", " ", "<|endoftext|>" * 3,
            "the quick brown fox\n\njumps  over 12 dogs' tails, didn't it?"]


@pytest.mark.parametrize("size", [0, 1, 500])
def test_encoder(library, size):
    given = texts()
    vocabulary = bpe.Vocabulary(PATH)
    words = list(dict.fromkeys(w.encode() for t in given for w in bpe.split(t) if len(w.encode()) <= bpe.LONGEST))[:size]
    encoder = bpe.Encoder(PATH, bpe.pack(bpe.compile_lexicon(dict(zip(words, vocabulary.merge_all(words))))))
    ids = encoder.encode(given)
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == [x.ids for x in library.encode_batch(given, add_special_tokens=False)]
    assert [encoder.decode(i).decode() for i in ids] == [library.decode(np.frombuffer(i, "<u4").tolist(), skip_special_tokens=False) for i in ids]


def test_automaton_is_minimal_and_exact():
    rng = random.Random(2)
    words = list({bytes(rng.choices(b"ab", k=rng.randint(1, 7))) for _ in range(90)})
    arrays = bpe.compile_lexicon({w: np.array([i], "<u4").tobytes() for i, w in enumerate(words)})
    # as many states as there are different sets of endings
    prefixes = {w[:k] for w in words for k in range(len(w) + 1)}
    assert len(arrays["final"]) == len({frozenset(w[len(p):] for w in words if w.startswith(p)) for p in prefixes})
    lexicon = bpe.Lexicon(bpe.pack(arrays))
    asked = [*words, *(bytes(rng.choices(b"abc", k=rng.randint(0, 8))) for _ in range(500))]
    order = {w: i for i, w in enumerate(sorted(words))}
    assert lexicon.find(asked).tolist() == [order.get(w, -1) for w in asked]


def test_query(spark, documents, write, library):
    given = [None, *texts()[-40:], "the quick", "the quick"]
    rows = bpe.op5_bpe(spark, write(documents=documents(*given))).collect()
    assert len(rows) == len(given)
    for row in rows:
        ids = library.encode(given[row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_general_form_and_empty_table(spark, documents):
    docs = documents(None, "to be").selectExpr("*", "1 as ids")
    rows = {r.doc_id: (r.ids, r.decoded) for r in bpe.with_ids(docs).collect()}
    assert rows[0] == ([], "") and rows[1][1] == "to be" and len(rows[1][0]) == 2
    assert bpe.with_ids(docs.where("false")).collect() == []
