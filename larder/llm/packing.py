"""Best-fit packing of tokenised documents into sequences under several capacities.

A piece of ``n`` tokens takes ``n`` tokens, one document and ``n * n`` attention cost from
what its sequence has left. Pieces go from the longest to the shortest, each into the open
sequence that the score picks among those with room under every capacity: the least
weighted norm of what is left after it, or the largest weighted dot product of the piece with
what is left. A new one is opened only if none has room.

What a piece takes follows from its length alone, so the search needs the number of pieces of each
length and no pieces: at most as many rows as a sequence has tokens, however large the
corpus. Sequences that are alike are kept as one class with a number of members, and a step fills
all it can of the best class. The outcome, the same as with one piece at a time, is a list of
runs: the pieces of a length with ranks from ``first`` on go, ``per`` at a time, into sequences
numbered from ``sequence`` on. Spark gives every piece its rank among those of its length.
"""

import json
import math
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from larder.llm.common import ship, stage, table

# Fixed by the contract.
TOKENS = 4096
END = 1
TOKENIZER = "word_bpe_49k.json"

_SLICE = 1_000_000  # characters tokenised at a time
_CALL = 256  # strings given to the tokenizer at a time, as it answers with far more than ids
_KNOWN = 3_000_000  # characters of different words kept with their ids
_RANKS = 1 << 44  # more than the pieces of one length


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds, and how much each part counts when sequences are compared.

    Without limits of their own, documents and attention cost cannot run out before tokens do.
    A piece is never longer than what an empty sequence takes.
    """

    tokens: int = TOKENS
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    score: str = "norm"

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], dtype=np.int64)

    def longest(self) -> int:
        return min(self.tokens, math.isqrt(int(self.limits()[2])))


class _Classes:
    """Classes of like sequences: the first one's number, how many, and what each has left."""

    def __init__(self, width: int):
        self.first = np.zeros(256, dtype=np.int64)
        self.many = np.zeros(256, dtype=np.int64)
        self.left = np.zeros((256, width), dtype=np.int64)
        self.n = 0

    def add(self, first: int, many: int, left: np.ndarray) -> None:
        if self.n == len(self.first):
            self.first, self.many, self.left = (np.concatenate([a, np.zeros_like(a)]) for a in (self.first, self.many, self.left))
        self.first[self.n], self.many[self.n], self.left[self.n] = first, many, left
        self.n += 1

    def drop_full(self, least: int) -> None:
        """Forget classes without room for a piece of ``least`` tokens."""
        keep = (self.left[:self.n, 0] >= least) & (self.left[:self.n, 1] > 0)
        n = int(keep.sum())
        for a in (self.first, self.many, self.left):
            a[:n] = a[:self.n][keep]
        self.n = n


def plan(counts: dict[int, int], capacity: Capacity = Capacity()) -> np.ndarray:
    """Runs (length, first rank, pieces, per sequence, first sequence, offset), by length and rank.

    ``counts`` has the number of pieces of each length; none is longer than ``capacity.longest()``.
    """
    limits = capacity.limits()
    weights = np.array(capacity.weights) / limits.astype(float) ** 2
    classes = _Classes(len(limits))
    runs, opened = [], 0
    lengths = sorted((n for n, many in counts.items() if many), reverse=True)
    for length in lengths:
        classes.drop_full(lengths[-1])
        piece = np.array([length, 1, length * length], dtype=np.int64)
        rank, todo = 0, counts[length]
        while todo:
            left = classes.left[:classes.n]
            room = np.flatnonzero((left >= piece).all(axis=1))
            if len(room):
                if capacity.score == "norm":
                    pick = room[np.argmin(((left[room] - piece).astype(float) ** 2) @ weights)]
                    per = int((left[pick] // piece).min())
                else:
                    pick = room[np.argmax((left[room].astype(float) * piece) @ weights)]
                    per = 1
            else:
                # the only ones with room are those just opened, so they fill up one by one
                per = int((limits // piece).min())
                classes.add(opened, -(-todo // per), limits)
                pick, opened = classes.n - 1, opened - (-todo // per)
            per = min(per, todo)
            first, many, before = int(classes.first[pick]), int(classes.many[pick]), classes.left[pick].copy()
            full = min(many, todo // per)
            rest = todo - full * per if full < many else 0
            offset = int(limits[0] - before[0])
            runs.append((length, rank, full * per, per, first, offset))
            classes.left[pick], classes.many[pick] = before - per * piece, full
            if rest:
                runs.append((length, rank + full * per, rest, rest, first + full, offset))
                classes.add(first + full, 1, before - rest * piece)
            if full + (rest > 0) < many:
                classes.add(first + full + (rest > 0), many - full - (rest > 0), before)
            rank, todo = rank + full * per + rest, todo - full * per - rest
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 6)


class _Numbered(dict):
    """Gives a key not seen before the next number, and lists it in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.new.append(key)
        return number


class Ids:
    """Token ids of texts, the same as of each whole text at once.

    The tokenizer never looks across a blank, nor across a letter and the mark behind it, so
    it is asked once for each different part between blanks, without a mark at its end and
    in small letters. Parts of letters alone are one word each, and the last token of a word tells that it
    is, so many of them go in one call. Other parts go one by one, as they are, but for letters and
    a run of marks that is one token. Words of small letters need no normalizer and no pattern.
    """

    _MARKS = ".,;:!?"
    # Not the apostrophe, which may begin an ending.
    _MARKED = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]+)")
    _NORMALIZERS = {"NFC", "Replace", "Lowercase"}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.of_words = self._plain(Tokenizer)
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends_word[i] = token.endswith("</w>")
        self.marks = {m: int(self._encode([m])[0][0]) for m in self._MARKS}
        self.forget()

    def _plain(self, kind: type) -> "Tokenizer":
        """The same model, cutting at blanks alone, if all else that the tokenizer does leaves small letters as they are."""
        parts = json.loads(self.tokenizer.to_str())
        before, cuts = parts["normalizer"] or {}, parts["pre_tokenizer"] or {}
        steps = {step["type"] for step in before.get("normalizers", [before]) if step}
        inner = [step for step in cuts.get("pretokenizers", [cuts]) if step and step["type"] == "ByteLevel"]
        if not steps <= self._NORMALIZERS or [step["use_regex"] or step["add_prefix_space"] for step in inner] != [False]:
            return self.tokenizer
        pieces = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *inner]}
        return kind.from_str(json.dumps({**parts, "added_tokens": [], "normalizer": None, "pre_tokenizer": pieces}))

    def _encode(self, texts: list[str], tokenizer: "Tokenizer | None" = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one after the other, and how many each has."""
        tokenizer = tokenizer or self.tokenizer
        ids, sizes = [], []
        for at in range(0, len(texts), _CALL):
            found = [e.ids for e in tokenizer.encode_batch_fast(texts[at:at + _CALL], add_special_tokens=False)]
            sizes += map(len, found)
            ids.append(np.fromiter(chain.from_iterable(found), dtype=np.uint32))
        return np.concatenate([np.zeros(0, dtype=np.uint32), *ids]), np.array(sizes, dtype=np.int64)

    def forget(self) -> None:
        self.known = _Numbered()  # parts as they stand in texts
        self.cores: dict[str, int] = {}  # and without mark, in small letters
        self.runs: dict[str, int] = {}  # runs of marks with their id, -1 if that is more than one
        self.chars = 0
        self.core = np.zeros(0, dtype=np.int64)
        self.mark = np.zeros(0, dtype=np.int64)
        self.pool = np.zeros(0, dtype=np.uint32)
        self.starts = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, one after the other, and how many each has."""
        ids, _ = self._encode([" ".join(words[i:i + 100]) for i in range(0, len(words), 100)], self.of_words)
        sizes = np.diff(np.flatnonzero(self.ends_word[ids]), prepend=-1)
        if len(sizes) != len(words):
            raise ValueError("the vocabulary does not mark the ends of words")
        return ids, sizes

    def _run(self, run: str) -> int:
        if run not in self.runs:
            ids = self._encode([run])[0]
            self.runs[run] = int(ids[0]) if len(ids) == 1 else -1
        return self.runs[run]

    def _learn_cores(self, new: list[str], plain: list[bool]) -> None:
        words = [c for c, p in zip(new, plain) if p]
        others = [c for c, p in zip(new, plain) if not p]
        ids, sizes = self._words(words)
        other_ids, other_sizes = self._encode(others)
        sizes = np.concatenate([sizes, other_sizes])
        self.cores.update(zip(words + others, range(len(self.cores), len(self.cores) + len(new))))
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.pool = np.concatenate([self.pool, ids, other_ids])

    def learn(self) -> None:
        """Ids of the parts numbered since the last call."""
        parts, self.known.new = self.known.new, []
        cores, marks, plain = [], [], {}
        for part in parts:
            mark = -1
            if part[-1:] in self.marks and part[-2:-1].isalpha() and part[-2] <= "ÿ":
                mark, part = self.marks[part[-1]], part[:-1]
            if part.isalpha() and (part.isascii() or max(part) <= "ÿ"):
                part = part.lower()
                plain[part] = True
            elif mark < 0 and (found := self._MARKED.fullmatch(part)) and (run := self._run(found[2])) >= 0:
                part, mark = found[1].lower(), run
                plain[part] = True
            cores.append(part)
            marks.append(mark)
        new = [c for c in dict.fromkeys(cores) if c not in self.cores]
        self._learn_cores(new, [c in plain for c in new])
        self.core = np.concatenate([self.core, np.fromiter(map(self.cores.__getitem__, cores), dtype=np.int64, count=len(cores))])
        self.mark = np.concatenate([self.mark, np.array(marks, dtype=np.int64)])
        self.chars += sum(map(len, parts))

    def of(self, texts: list[str]) -> list[np.ndarray]:
        if self.chars > _KNOWN:
            self.forget()
        parts = [t.replace("\n", " ").split(" ") for t in texts]
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(parts)), dtype=np.int64, count=sum(map(len, parts)))
        if self.known.new:
            self.learn()
        core, mark = self.core[at], self.mark[at]
        marked = mark >= 0
        sizes = self.sizes[core] + marked
        ends = np.cumsum(sizes)
        place = np.repeat(self.starts[core] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        place[ends[marked] - 1] = 0
        flat = self.pool[place] if len(self.pool) else np.zeros(len(place), dtype=np.uint32)
        flat[ends[marked] - 1] = mark[marked]
        last = np.cumsum([len(p) for p in parts]) - 1
        return np.split(flat, ends[last][:-1]) if texts else []


_sources: dict[str, Ids] = {}


def _source(path: str) -> Ids:
    """A worker's only one: the next task finds the words of those before."""
    if path not in _sources:
        _sources.clear()
        _sources[path] = Ids(path)
    return _sources[path]


def _slices(texts: Iterable[pa.Scalar]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``_SLICE`` characters, with the place of the first; a longer text is alone."""
    start, run, chars = 0, [], 0
    for i, text in enumerate(texts):
        text = text.as_py() or ""
        if run and chars + len(text) > _SLICE:
            yield start, run
            start, run, chars = i, [], 0
        run.append(text)
        chars += len(text)
    if run:
        yield start, run


def pieces(docs: DataFrame, longest: int = TOKENS, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Pieces of each document's ids: doc_id, piece, start, length, ids_crc32, part, place, with ``keep_ids`` ids.

    ``place`` numbers the pieces of one length in one task, ``part``, from 0. A null text is empty and so has
    the end token alone. Columns other than doc_id and text are left out.
    """
    ship(docs.sparkSession)
    path = path or public_tokenizers.path(TOKENIZER)
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType),
              *[T.StructField(c, T.LongType()) for c in ("piece", "start", "length", "ids_crc32", "part", "place")]]
    schema = T.StructType(fields + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if keep_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, part = _source(path), TaskContext.get().partitionId()
        seen = np.zeros(longest + 1, dtype=np.int64)
        types = to_arrow_schema(schema)
        for batch in batches:
            for start, run in _slices(batch.column("text")):
                found = [np.append(ids, np.uint32(END)).astype("<u4") for ids in source.of(run)]
                many = np.array([-(-len(ids) // longest) for ids in found], dtype=np.int64)
                row = np.repeat(np.arange(len(found)), many)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                cut = [found[r][p * longest:(p + 1) * longest] for r, p in zip(row.tolist(), piece.tolist())]
                length = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
                order = np.argsort(length, kind="stable")
                by_length = length[order]
                place = np.empty(len(cut), dtype=np.int64)
                place[order] = np.arange(len(cut)) - np.searchsorted(by_length, by_length) + seen[by_length]
                seen += np.bincount(length, minlength=longest + 1)
                columns = [batch.column("doc_id").take(pa.array(row + start)), piece, piece * longest, length,
                           np.fromiter((zlib.crc32(c) for c in cut), dtype=np.int64, count=len(cut)), np.full(len(cut), part), place]
                if keep_ids:
                    columns.append([c.astype(np.int32) for c in cut])
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(docs: DataFrame, capacity: Capacity = Capacity(), path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Every piece with its ``sequence_id`` and its ``offset`` there.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset, with ``keep_ids`` ids. Rows with
    equal or null doc_ids are packed each on their own; no rows give no rows. Writes the pieces once in
    the shared folder; runs over the counts per length, whose number is bounded by ``capacity.tokens``.
    """
    cut = stage(pieces(docs, capacity.longest(), path, keep_ids))
    counts = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(totals, capacity)
    starts = runs[:, 0] * _RANKS + runs[:, 1]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("place"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
    extra = ["ids"] if keep_ids else []

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = runs[np.searchsorted(starts, length.to_numpy() * _RANKS + rank.to_numpy(), side="right") - 1]
        later = rank.to_numpy() - at[:, 1]
        return pd.DataFrame({"sequence_id": at[:, 4] + later // at[:, 3], "offset": at[:, 5] + later % at[:, 3] * at[:, 0]})

    return ranked.withColumn("_at", placed("length", "rank")).select(*kept, "_at.sequence_id", "_at.offset", *extra)


def sequences(packed: DataFrame) -> DataFrame:
    """Each sequence: sequence_id, ids, and ``starts``, where its pieces begin. Needs the ids of ``pack``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("starts"))


def op11_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 4096 tokens."""
    return pack(table(spark, sf_dir, "documents"))
