"""Packing in classes against one piece at a time, ids against the tokenizer on whole texts."""

import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from larder.llm import packing as op

PATH = public_tokenizers.path(op.TOKENIZER)
ODD = ["", None, " ", "Hello,  world!\nIt's 3 o'clock.", "á é x y\x1cz\x85w", "ΑΣ ΣΑΣ İI", "<|endoftext|> a<|startoftext|>b",
       "x" * 30_000, "\t\r\n tab\x0b", "🙂👩‍👩‍👧 word", "word " * 9000, "don't can'T WE'LL"]


def one_by_one(lengths, capacity):
    """What each sequence has left, packing piece by piece."""
    limits = capacity.limits().tolist()
    weights = [w / x**2 for w, x in zip(capacity.weights, limits)]
    left = []
    for n in sorted(lengths, reverse=True):
        piece = (n, 1, n * n)
        room = [s for s in left if all(a >= b for a, b in zip(s, piece))]
        if not room:
            left.append(list(limits))
            room = [left[-1]]
        if capacity.score == "norm":
            best = min(room, key=lambda s: sum(w * (a - b) ** 2 for w, a, b in zip(weights, s, piece)))
        else:
            best = max(room, key=lambda s: sum(w * a * b for w, a, b in zip(weights, s, piece)))
        best[:] = [a - b for a, b in zip(best, piece)]
    return sorted(map(tuple, left))


def filled(runs, capacity):
    """What each sequence of a plan has left; checks that pieces follow each other without gaps."""
    inside = defaultdict(list)
    for length, _, n, per, sequence, offset in runs.tolist():
        for j in range(n):
            inside[sequence + j // per].append((offset + j % per * length, length))
    left = []
    for found in inside.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        used = (end, len(found), sum(n * n for _, n in found))
        left.append(tuple(a - b for a, b in zip(capacity.limits().tolist(), used)))
    assert sorted(inside) == list(range(len(inside)))
    return sorted(left)


@pytest.mark.parametrize("capacity", [
    op.Capacity(64), op.Capacity(64, score="dot"), op.Capacity(64, 3), op.Capacity(64, 5, 900, (1.0, 0.3, 0.7)),
    op.Capacity(64, 4, 1500, (0.2, 1.0, 0.5), "dot")])
def test_classes_equal_single_pieces(capacity):
    rng = random.Random(7)
    for _ in range(60):
        longest = capacity.longest()
        lengths = [min(longest, rng.choice([1, 2, rng.randint(1, longest), rng.randint(1, longest)])) for _ in range(rng.randint(1, 120))]
        runs = op.plan(dict(Counter(lengths)), capacity)
        for length, many in Counter(lengths).items():
            own = runs[runs[:, 0] == length]
            assert own[:, 2].sum() == many and own[0, 1] == 0 and (own[1:, 1] == np.cumsum(own[:, 2])[:-1]).all()
        left = filled(runs, capacity)
        assert min(map(min, left)) >= 0
        assert left == one_by_one(lengths, capacity)


def test_plan_does_not_grow_with_pieces():
    rng = random.Random(8)
    counts = {n: rng.randint(1, 50) for n in range(1, 4097)}
    small, large = op.plan(counts), op.plan({n: many * 10_000_000 for n, many in counts.items()})
    assert len(large) < 3 * len(small) < 200_000
    total = sum(n * many for n, many in counts.items()) * 10_000_000
    assert (large[:, 4] + -(-large[:, 2] // large[:, 3])).max() * 4096 < total * 1.003
    assert len(op.plan({})) == 0


def test_ids_equal_whole_texts():
    tokenizer = Tokenizer.from_file(PATH)
    rng = random.Random(9)
    letters = "abcdeABCÉßσΣ'’.,!?<|>-_0123456789 \n\t ́​漢字"
    texts = [t or "" for t in ODD] + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(2000)]
    source = op.Ids(PATH)
    for _ in range(2):
        assert [ids.tolist() for ids in source.of(texts)] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        source.chars = op._KNOWN + 1
    assert source.of([]) == []


def test_tokenizer_is_asked_for_few_strings_at_a_time():
    """Its answers are far larger than ids, so that a worker's memory hangs on how many it gives at once."""
    source, asked = op.Ids(PATH), []
    whole = source.tokenizer

    class Counted:
        def encode_batch_fast(self, texts, **options):
            asked.append(len(texts))
            return whole.encode_batch_fast(texts, **options)

    source.tokenizer = Counted()
    text = " ".join(f"{i}x{i * i}" for i in range(3000))
    assert source.of([text])[0].tolist() == whole.encode(text, add_special_tokens=False).ids
    assert max(asked) <= 256


def check(rows, docs, capacity):
    """Pieces are those of the tokenizer, sequences without gaps and within capacity."""
    tokenizer = Tokenizer.from_file(PATH)
    longest = capacity.longest()
    want = Counter()
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for p, start in enumerate(range(0, len(ids), longest)):
            part = np.array(ids[start:start + longest], dtype="<u4")
            want[doc, p, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    inside = defaultdict(list)
    for r in rows:
        inside[r["sequence_id"]].append((r["offset"], r["length"]))
    for found in inside.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert (np.array([end, len(found), sum(n * n for _, n in found)]) <= capacity.limits()).all()
    assert len(inside) == len(one_by_one([r["length"] for r in rows], capacity))


@pytest.mark.parametrize("capacity", [op.Capacity(), op.Capacity(64, 3, 2000)])
def test_pack(spark, capacity):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(None, "same text"), (None, "same text"), (3, ODD[3]), (None, None)]
    docs += [(100 + i, "some words here " * (i % 40)) for i in range(200)]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, piece string, length int").repartition(7)
    packed = op.pack(df, capacity, keep_ids=True)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]
    rows = packed.collect()
    check(rows, docs, capacity)
    at = {(r["sequence_id"], r["offset"]): r["ids"] for r in rows}
    made = op.sequences(packed).collect()
    assert len(made) == len({s for s, _ in at})
    for r in made:
        assert sum((at[r["sequence_id"], s] for s in r["starts"]), []) == r["ids"]


def test_no_rows(spark):
    assert op.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark, write, documents):
    texts = [t for t in ODD if t is None or len(t) < 5000] * 3
    got = op.op11_best_fit_packing(spark, write(documents=documents(*texts)))
    check(got.collect(), list(enumerate(texts)), op.Capacity())


def test_marks_of_one_token_do_not_make_a_word_unknown():
    source = op.Ids(public_tokenizers.path(op.TOKENIZER))
    texts = ["Envi*** été*** envi$$$ o'er*** a&&&", "envi*** 9*** <|endoftext|>*** été..."]
    want = [e.ids for e in source.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in source.of(texts)] == want
    assert {"envi", "été"} <= set(source.cores) and not {"envi***", "Envi***", "été***", "envi$$$"} & set(source.cores)


def test_words_are_cut_at_blanks_alone_only_if_nothing_else_touches_them(tmp_path):
    path = public_tokenizers.path(op.TOKENIZER)
    words = ["straße", "µm", "ªº", "abc"]
    source = op.Ids(path)
    assert source.of_words is not source.tokenizer
    assert source._words(words)[0].tolist() == [i for w in words for i in source.tokenizer.encode(w, add_special_tokens=False).ids]
    other = json.loads(open(path).read())
    other["normalizer"] = {"type": "StripAccents"}
    (tmp_path / "other.json").write_text(json.dumps(other))
    odd = op.Ids(str(tmp_path / "other.json"))
    assert odd.of_words is odd.tokenizer
