"""Greedy word-piece counts by a linear longest-match automaton.

The pieces form a trie with two roots, one for the start of a word and one for what
follows. A state that cannot go on has a failure link to the state that is reached by
popping the longest pieces off its front, and the number of pieces popped. So a word is read once,
byte by byte, and its number of pieces summed up without building any piece.
"""

import json
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from larder.llm.common import table

VOCABULARY = "byte_bpe_50k.json"
LONGEST = 256  # bytes of words that are stepped together; longer ones are stepped one by one
_NONE = -1
START, REST = 0, 1


class Automaton:
    """Counts the pieces of words under longest match first.

    ``first`` are the pieces that may begin a word, ``rest`` those that may follow. A
    word that the pieces cannot spell counts as one unknown piece.
    """

    def __init__(self, first: Iterable[bytes], rest: Iterable[bytes]):
        edges: list[dict[int, int]] = [{}, {}]
        ends = [False, False]
        for root, pieces in ((START, first), (REST, rest)):
            for piece in pieces:
                at = root
                for byte in piece:
                    if byte not in edges[at]:
                        edges[at][byte] = len(edges)
                        edges.append({})
                        ends.append(False)
                    at = edges[at][byte]
                ends[at] = at > REST
        fail, pops = [_NONE] * len(edges), [0] * len(edges)
        queue = deque((root, byte, to) for root in (START, REST) for byte, to in edges[root].items())
        while queue:
            parent, byte, state = queue.popleft()
            if ends[state]:
                fail[state], pops[state] = REST, 1
            else:
                at, popped = fail[parent], pops[parent]
                while at != _NONE and byte not in edges[at]:
                    popped += pops[at]
                    at = fail[at]
                if at != _NONE:
                    fail[state], pops[state] = edges[at][byte], popped
            queue.extend((state, b, to) for b, to in edges[state].items())
        self.edges, self.fail, self.pops = edges, np.array(fail), np.array(pops)
        flat = sorted((state << 8 | byte, to) for state, out in enumerate(edges) for byte, to in out.items())
        self.keys, self.targets = (np.array([x[k] for x in flat], dtype=np.int64) for k in range(2))

    def count(self, word: bytes) -> int:
        """The pieces of one word; 0 for the empty word."""
        state, n = START, 0
        for byte in word:
            while byte not in self.edges[state]:
                if self.fail[state] == _NONE:
                    return 1
                n += int(self.pops[state])
                state = self.fail[state]
            state = self.edges[state][byte]
        while state > REST:
            if self.fail[state] == _NONE:
                return 1
            n += int(self.pops[state])
            state = self.fail[state]
        return n

    def _pop(self, rows: np.ndarray, state: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Follows failure links; the rows that have one. The others are unknown words."""
        at = state[rows]
        able = self.fail[at] != _NONE
        n[rows[~able]] = _NONE
        rows, at = rows[able], at[able]
        n[rows] += self.pops[at]
        state[rows] = self.fail[at]
        return rows

    def count_all(self, words: list[bytes]) -> np.ndarray:
        """The pieces of each word. The words step through the automaton together."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        text = np.frombuffer(b"".join(words), dtype=np.uint8)
        starts = np.cumsum(sizes) - sizes
        n, state = np.zeros(len(words), dtype=np.int64), np.full(len(words), START)
        short = sizes <= LONGEST
        going = np.flatnonzero(short)
        for k in range(LONGEST + 1):
            over = going[sizes[going] == k]
            while len(over := over[state[over] > REST]):
                over = self._pop(over, state, n)
            going = going[sizes[going] > k]
            if not len(going):
                break
            rows, reached = going, []
            while len(rows):
                wanted = state[rows] << 8 | text[starts[rows] + k]
                at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
                hit = self.keys[at] == wanted
                state[rows[hit]] = self.targets[at[hit]]
                reached.append(rows[hit])
                rows = self._pop(rows[~hit], state, n)
            going = np.concatenate(reached)
        n[n == _NONE] = 1
        for i in np.flatnonzero(~short).tolist():
            n[i] = self.count(words[i])
        return n


def from_byte_bpe(path: str) -> Automaton:
    """Pieces from a byte-level vocabulary: those behind a space may begin a word, the others may follow.

    Single bytes may stand anywhere, so there are no unknown words.
    """
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)["model"]["vocab"]
    # fixed by byte-level vocabularies: printable bytes stand for themselves, the others for code points from 256 on
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    pieces = [bytes(of[c] for c in token) for token in tokens]
    solid = lambda piece: piece and not any(b in b" \t\n\x0b\x0c\r" for b in piece)
    single = [bytes([b]) for b in range(256)]
    return Automaton([*single, *(p[1:] for p in pieces if p[:1] == b" " and solid(p[1:]))], [*single, *filter(solid, pieces)])


_automata: dict[str, Automaton] = {}


def counted(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_tokens`` of every row; both 0 for null, empty and blank texts.

    ``path`` is the vocabulary's file, which must be there on every executor; by
    default that of the installed package.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = path or public_tokenizers.path(VOCABULARY)
        if where not in _automata:
            _automata[where] = from_byte_bpe(where)
        for batch in batches:
            texts = [(t or "").encode().split() for t in batch.column("text").to_pylist()]
            words = list(dict.fromkeys(w for text in texts for w in text))
            pieces = dict(zip(words, _automata[where].count_all(words).tolist())) if words else {}
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(t) for t in texts], type=pa.int64()),
                pa.array([sum(map(pieces.__getitem__, t)) for t in texts], type=pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_tokens long")


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    """Words and greedy word pieces of every document."""
    return counted(table(spark, sf_dir, "documents"))
