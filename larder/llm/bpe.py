"""Byte-level BPE with a lexicon of frequent words as a minimal acyclic transducer.

The corpus's frequent words are merged once and compiled into an automaton that shares
prefixes and suffixes. Each edge carries a number; their sum along a word is the word's
place in the table of outputs, its ids. The automaton is a few arrays in one file that
every task maps into memory. Words it does not accept are merged exactly.
"""

import hashlib
import heapq
import json
import os
import re
import tempfile
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from larder.llm.common import most_frequent, stage, table

VOCABULARY = "byte_bpe_50k.json"
WORDS = 65_536  # frequent words compiled, at most; bounds what is broadcast
LONGEST = 64  # bytes of a compiled word
MEMO = 200_000  # merged words that a worker remembers
_LENGTHS = (4, 8, 12, 16, 24, 32, 64)  # words up to the same of these are merged together
_NONE = 1 << 30  # the rank of a pair that is not merged

# Fixed by the byte-level pre-tokenizer: how a text is split before merging. White space is
# Unicode's property, which leaves out U+001C to U+001F.
_SPACE = r"\t-\r \x85\xa0  -     　"
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^{S}{l}{n}]+|[{S}]+(?![^{S}])|[{S}]+"
_ANY = regex.compile(_SPLIT.format(S=_SPACE, L=r"\p{L}", N=r"\p{N}", l=r"\p{L}", n=r"\p{N}"))
# The same for texts of ASCII and Latin letters alone, where plain ranges will do.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_LATIN = re.compile(_SPLIT.format(S=_SPACE, L=f"[{_LETTERS}]", N="[0-9]", l=_LETTERS, n="0-9"))
_OTHER = re.compile(f"[^\x00-\x7f{_LETTERS}]")


_LIBRARY = ByteLevel(add_prefix_space=False)


def split(text: str) -> list[str]:
    """The words of a text as the tokenizer takes them.

    Unicode's newest letters are not letters in every library; texts with a code point
    that is not assigned here are split by the tokenizer's own rule.
    """
    if not _OTHER.search(text):
        return _LATIN.findall(text)
    if all(unicodedata.category(c) != "Cn" for c in set(text)):
        return _ANY.findall(text)
    return [text[a:b] for _, (a, b) in _LIBRARY.pre_tokenize_str(text)]


class Vocabulary:
    """Ids, merges and bytes of tokens, from the file of a byte-level BPE tokenizer."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        # printable bytes stand for themselves, the others for code points from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        chars = {chr(b): b for b in plain}
        chars |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        ids = spec["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in ids.items():
            self.bytes[i] = bytes(chars[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        of_byte = {chars[c]: ids[c] for c in chars}
        self.of_byte = [of_byte[b] for b in range(256)]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[a], ids[b]] = rank, ids[a + b]

        # the same as arrays: ranks of pairs of bytes, and of pairs of ids by a search for their key
        items = sorted((a << 32 | b, rank, new) for (a, b), (rank, new) in self.merges.items())
        self.keys, self.ranks, self.news = (np.array([x[k] for x in items], dtype=np.int64 if k == 0 else np.int32) for k in range(3))
        self.by_rank = np.zeros(len(items), dtype=np.int32)
        self.by_rank[self.ranks] = self.news

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], np.int32(_NONE))

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """The ids of words, packed: of all adjacent pairs, the first of least rank is merged, again and again.

        Words of like length take each step together; long ones use a heap.
        """
        out = [b""] * len(words)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        of_byte = np.array(self.of_byte, dtype=np.int32)
        low = 0
        for high in _LENGTHS:
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            if not len(rows):
                continue
            text = np.frombuffer(b"".join(words[i].ljust(high, b"\0") for i in rows.tolist()), dtype=np.uint8).reshape(-1, high)
            left = sizes[rows]
            ids = np.where(np.arange(high) < left[:, None], of_byte[text], np.int32(-1))
            ranks = self._rank(ids[:, :-1], ids[:, 1:])
            while len(rows):
                best = ranks.argmin(axis=1)
                rank = np.take_along_axis(ranks, best[:, None], axis=1)[:, 0]
                done = rank == _NONE
                if done.any():
                    for i, n, row in zip(rows[done].tolist(), left[done].tolist(), ids[done].astype("<u4")):
                        out[i] = row[:n].tobytes()
                    going = ~done
                    rows, left, ids, ranks, best, rank = rows[going], left[going], ids[going], ranks[going], best[going], rank[going]
                    if not len(rows):
                        break
                at = np.arange(len(rows))
                # everything behind the pair moves one place to the left
                ids[:, :-1] = np.where(np.arange(high - 1) > best[:, None], ids[:, 1:], ids[:, :-1])
                ids[:, -1] = -1
                ids[at, best] = self.by_rank[rank]
                ranks[:, :-1] = np.where(np.arange(high - 2) > best[:, None], ranks[:, 1:], ranks[:, :-1])
                ranks[:, -1] = _NONE
                left -= 1
                after = np.minimum(best + 1, high - 1)
                has = best < high - 1
                ranks[at[has], best[has]] = self._rank(ids[at, best], ids[at, after])[has]
                has = best > 0
                ranks[at[has], best[has] - 1] = self._rank(ids[at, best - 1], ids[at, best])[has]
        for i in np.flatnonzero(sizes > low).tolist():
            out[i] = np.array(self._merge_long([self.of_byte[b] for b in words[i]]), dtype="<u4").tobytes()
        return out

    def _merge_long(self, symbols: list[int]) -> list[int]:
        n, find = len(symbols), self.merges.get
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(m[0], i, m[1]) for i in range(n - 1) if (m := find((symbols[i], symbols[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, new = heapq.heappop(heap)
            j = right[i]
            if symbols[i] < 0 or j < 0 or (m := find((symbols[i], symbols[j]))) is None or m[1] != new:
                continue
            symbols[i], symbols[j] = new, -1
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b >= 0 and (m := find((symbols[a], symbols[b]))):
                    heapq.heappush(heap, (m[0], a, m[1]))
        return [s for s in symbols if s >= 0]


def compile_lexicon(entries: dict[bytes, bytes]) -> dict[str, np.ndarray]:
    """The minimal automaton of words and their packed ids, as arrays.

    ``keys`` holds state * 256 + byte in rising order, ``targets`` the state that follows and
    ``adds`` the number on the edge. State 0 is the start; ``final`` marks accepting ones.
    """
    words = sorted(entries)
    # a state: [accepting, {byte: state}]; finished ones are looked up by what follows from them
    known: dict[tuple, int] = {}
    states: list[tuple] = []

    def finish(state: list) -> int:
        key = (state[0], tuple(state[1].items()))
        if key not in known:
            known[key] = len(states)
            states.append(key)
        return known[key]

    path: list[list] = [[False, {}]]

    def fold(depth: int, word: bytes) -> None:
        while len(path) > depth + 1:
            done = finish(path.pop())
            path[-1][1][word[len(path) - 1]] = done

    last = b""
    for word in words:
        shared = 0
        while shared < min(len(last), len(word)) and last[shared] == word[shared]:
            shared += 1
        fold(shared, last)
        path += [[False, {}] for _ in word[shared:]]
        path[-1][0] = True
        last = word
    fold(0, last)
    start = finish(path[0])
    # children are finished before their parents, so counts are there when needed
    counts = []
    for final, edges in states:
        counts.append(final + sum(counts[t] for _, t in edges))
    name = {start: 0}
    for i in range(len(states)):
        name.setdefault(i, len(name))
    rows = []
    for i, (final, edges) in enumerate(states):
        before = int(final)
        for byte, target in edges:
            rows.append((name[i] * 256 + byte, name[target], before))
            before += counts[target]
    rows.sort()
    final = np.zeros(len(states), dtype=np.int64)
    for i, (accepts, _) in enumerate(states):
        final[name[i]] = accepts
    keys, targets, adds = (np.array([r[k] for r in rows], dtype=np.int64) for k in range(3))
    sizes = [len(entries[w]) // 4 for w in words]
    return {"keys": keys, "targets": targets, "adds": adds, "final": final,
            "offsets": np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
            "ids": np.frombuffer(b"".join(entries[w] for w in words), dtype="<u4").astype(np.int64)}


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """The arrays one after the other, behind their lengths."""
    return np.array([len(a) for a in arrays.values()], dtype=np.int64).tobytes() + b"".join(a.tobytes() for a in arrays.values())


class Lexicon:
    """A packed automaton, mapped into memory."""

    def __init__(self, packed: bytes):
        handle, path = tempfile.mkstemp(prefix="larder-lexicon-")
        with os.fdopen(handle, "wb") as file:
            file.write(packed)
        data = np.memmap(path, dtype=np.int64, mode="r")
        os.unlink(path)  # the mapping keeps the file's pages for as long as it is used
        ends = 6 + np.cumsum(data[:6])
        self.keys, self.targets, self.adds, self.final, self.offsets, self.ids = (data[b - n:b] for b, n in zip(ends, data[:6]))

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word among the outputs, or -1. All words step through the automaton together."""
        n = len(words)
        place, state = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        if not n or not len(self.keys):
            return np.full(n, -1, dtype=np.int64)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
        text = np.frombuffer(b"".join(words), dtype=np.uint8)
        starts = np.cumsum(sizes) - sizes
        place[(sizes > LONGEST) | (sizes == 0)] = -1
        going = np.flatnonzero(place >= 0)
        for k in range(LONGEST):
            going = going[sizes[going] > k]
            if not len(going):
                break
            wanted = state[going] * 256 + text[starts[going] + k]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = self.keys[at] == wanted
            place[going[~hit]] = -1
            going, at = going[hit], at[hit]
            state[going] = self.targets[at]
            place[going] += self.adds[at]
        place[(place >= 0) & (self.final[state] == 0)] = -1
        return place


class Encoder:
    """Encodes and decodes texts; made once in each worker."""

    def __init__(self, path: str, packed: bytes):
        self.vocabulary, self.lexicon = Vocabulary(path), Lexicon(packed)
        self.special = re.compile("|".join(map(re.escape, self.vocabulary.special)) or r"(?!)")
        self.memo: dict[str, bytes] = {}
        bounds = self.lexicon.offsets.tolist()
        ids = np.asarray(self.lexicon.ids).astype("<u4")
        self.outputs = [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers; none for null."""
        pieces = []
        for text in texts:
            parts = []
            at = 0
            for m in self.special.finditer(text or ""):
                parts += [split(text[at:m.start()]), self.vocabulary.special[m[0]]]
                at = m.end()
            parts.append(split((text or "")[at:]))
            pieces.append(parts)
        words = list(dict.fromkeys(w for parts in pieces for part in parts if isinstance(part, list) for w in part))
        found = self.lexicon.find([w.encode() for w in words]).tolist()
        ids = {word: self.outputs[place] for word, place in zip(words, found) if place >= 0}
        unseen = [word for word in words if word not in ids]
        new = [word for word in unseen if word not in self.memo]
        ids |= {word: self.memo[word] for word in unseen if word in self.memo}
        merged = dict(zip(new, self.vocabulary.merge_all([word.encode() for word in new])))
        ids |= merged
        if len(self.memo) + len(merged) > MEMO:
            self.memo.clear()
        self.memo.update((word, packed) for word, packed in merged.items() if len(packed) <= 4 * LONGEST)
        get = ids.__getitem__
        return [b"".join(b"".join(map(get, part)) if isinstance(part, list) else part.to_bytes(4, "little") for part in parts) for parts in pieces]

    def decode(self, ids: bytes) -> bytes:
        """The UTF-8 text of ids; special tokens give their strings."""
        return b"".join(map(self.vocabulary.bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def fit_lexicon(docs: DataFrame, path: str, words: int = WORDS) -> bytes:
    """The compiled lexicon of the most frequent words of all texts.

    Counting is one aggregate in Spark, written once; only the words chosen reach the
    driver, ``words`` at most.
    """
    pattern = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
    counted = docs.select(F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    counted = stage(counted.where((F.octet_length("word") <= LONGEST) & (F.col("n") > 1)))
    chosen = most_frequent(counted, words).select("word").collect()
    vocabulary = Vocabulary(path)
    frequent = [r["word"].encode() for r in chosen]
    return pack(compile_lexicon(dict(zip(frequent, vocabulary.merge_all(frequent)))))


_encoders: dict[tuple, Encoder] = {}


def _encoder(path: str, packed) -> Encoder:
    key = (path, packed.id if hasattr(packed, "id") else 0)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(path, packed.value)
    return _encoders[key]


def with_ids(docs: DataFrame, path: str | None = None, words: int = WORDS, batch: int = 256) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) and ``decoded``, the text that the ids give back, of every row.

    A null text has no ids and decodes to the empty text. ``path`` is the tokenizer's file,
    which must be there on every executor; by default that of the installed package.
    """
    return _coded(docs, path, words, batch, "doc_id long, ids array<int>, decoded string",
                  lambda texts, ids, back: [_arrays(ids), pa.array([b.decode() for b in back], type=pa.string())])


def encoded(docs: DataFrame, path: str | None = None, words: int = WORDS, batch: int = 256) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and ``exact``, whether the ids decode to the text, of every row."""
    return _coded(docs, path, words, batch, "doc_id long, n_tokens long, ids array<int>, exact boolean", lambda texts, ids, back: [
        pa.array([len(i) // 4 for i in ids], type=pa.int64()), _arrays(ids), pa.array([(t or "").encode() == b for t, b in zip(texts, back)])])


def _arrays(ids: list[bytes]) -> pa.ListArray:
    values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)), values)


def _coded(docs: DataFrame, path: str | None, words: int, batch: int, schema: str, shape) -> DataFrame:
    docs = docs.select("doc_id", "text")
    where = path or public_tokenizers.path(VOCABULARY)
    packed = docs.sparkSession.sparkContext.broadcast(fit_lexicon(docs, where, words))
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path or public_tokenizers.path(VOCABULARY), packed)
        for rows in batches:
            for at in range(0, rows.num_rows, batch):
                part = rows.slice(at, batch)
                texts = part.column("text").to_pylist()
                ids = encoder.encode(texts)
                back = [encoder.decode(i) for i in ids]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *shape(texts, ids, back)], names=names)

    return docs.mapInArrow(run, schema)


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the text that they give back."""
    sha = lambda values: pa.array([hashlib.sha256(v).hexdigest() for v in values])
    return _coded(table(spark, sf_dir, "documents"), None, WORDS, 256, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                  lambda texts, ids, back: [pa.array([len(i) // 4 for i in ids], type=pa.int64()), sha(ids), sha(back)])
