"""Removal of repeated passages by prefix-partitioned suffix trees.

A suffix here is a window of ``WINDOW`` words of one document, and it matters whether its
words start anywhere else too. Suffixes are split by a prefix: the ``ANCHOR`` words of the
window whose hash is least. Equal windows have equal anchors, and neighbouring windows
mostly share theirs, so a run of them moves to its group as one piece of text. Anchors
that occur once in the corpus drop out first. Anchors with more pieces than fit a task
are split by a longer prefix, the whole window.

Each task builds suffix trees over groups of pieces up to a given number of words, in array form:
suffixes in order and the words that neighbours have in common. Internal nodes at least
``WINDOW`` words deep are repeats, and the suffixes below them are covered.
"""

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stage, table

WINDOW = 35  # fixed by the contract
ANCHOR = 6
GROUP_PIECES = 20_000  # pieces of an anchor, at most, before it is split further
TREE_WORDS = 400_000  # words of the trees built at once, unless one group alone has more
_PART = 1 << 18  # words hashed at once
_PLACE = np.uint64((1 << 24) - 1)


def _anchors(codes: np.ndarray, owner: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with a common anchor: first word, number of windows, key of the anchor.

    ``codes`` are the words' checksums, ``owner`` names the document of each word;
    windows do not reach across documents.
    """
    starts = len(codes) - window + 1
    if starts <= 0:
        return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0, dtype=np.int64),)
    mixed = codes * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    n = len(codes) - anchor + 1
    keys = np.zeros(n, dtype=np.uint64)
    for j in range(anchor):
        keys = keys * np.uint64(0xBF58476D1CE4E5B9) + mixed[j:j + n]
    keys ^= keys >> np.uint64(31)
    keys *= np.uint64(0x94D049BB133111EB)
    keys ^= keys >> np.uint64(32)
    # the least hash of each window, and of equal ones the first: places fill the low bits
    least = (keys & ~_PLACE) | np.arange(n, dtype=np.uint64)
    reach, width = 1, window - anchor + 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[:len(least) - (width - reach)], least[width - reach:])
    whole = np.flatnonzero(owner[:starts] == owner[window - 1:])
    place = (least[whole] & _PLACE).astype(np.int64)
    first = np.ones(len(whole), dtype=bool)
    first[1:] = (place[1:] != place[:-1]) | (whole[1:] != whole[:-1] + 1)
    at = np.flatnonzero(first)
    return whole[at], np.diff([*at, len(whole)]), keys[place[at]].view(np.int64)


def runs(texts: list[list[bytes]], window: int = WINDOW, anchor: int = ANCHOR) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each text that has windows: its number, and its runs. Long texts come in overlapping parts."""
    parts: list[tuple[int, int, int]] = []  # text, from, to
    size = 0

    def out() -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        codes = np.fromiter((c for t, a, b in parts for c in map(zlib.crc32, texts[t][a:b])), dtype=np.uint64, count=size)
        sizes = np.array([b - a for _, a, b in parts])
        owner = np.repeat(np.arange(len(parts)), sizes)
        first, n, keys = _anchors(codes, owner, window, anchor)
        begins = np.cumsum(sizes) - sizes
        cuts = np.searchsorted(first, [*begins, size])
        for k, (t, a, _) in enumerate(parts):
            if cuts[k] < cuts[k + 1]:
                rows = slice(cuts[k], cuts[k + 1])
                yield t, first[rows] - begins[k] + a, n[rows], keys[rows]

    for t, words in enumerate(texts):
        for a in range(0, max(1, len(words) - window + 1), _PART):
            b = min(len(words), a + _PART + window - 1)
            if b - a < window:
                continue
            parts.append((t, a, b))
            size += b - a
            if size >= _PART:
                yield from out()
                parts, size = [], 0
    if parts:
        yield from out()


class SuffixTree:
    """The generalized suffix tree of pieces in array form; only pieces of one group share branches.

    ``order`` holds the suffixes (each a word's place in the joined pieces) in order, ``common`` how many
    words each has in common with the one before. An internal node is a stretch of ``order``.
    Suffixes shorter than ``least`` are left out.
    """

    def __init__(self, pieces: list[list[bytes]], groups: np.ndarray, least: int):
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        self.begins = np.cumsum(sizes) - sizes
        ids: dict[bytes, int] = {}
        names = np.fromiter((ids.setdefault(w, len(ids)) for p in pieces for w in p), dtype=np.int64, count=int(sizes.sum()))
        self.piece = np.repeat(np.arange(len(pieces)), sizes)
        left = (self.begins + sizes)[self.piece] - np.arange(len(names))  # words up to the end of the piece
        # names of stretches of 1, 2, 4, ... words keep their order; one past the end has none
        levels = [names]
        while 2 << len(levels) - 1 <= least:
            reach, last = 1 << len(levels) - 1, levels[-1]
            ahead = np.concatenate([last[reach:], np.full(min(reach, len(last)), -1)])
            pair = last * (len(names) + len(ids) + 1) + np.where(left >= 2 * reach, ahead, -1) + 1
            levels.append(np.unique(pair, return_inverse=True)[1])
        reach, last = 1 << len(levels) - 1, levels[-1]
        starts = np.flatnonzero(left >= least)
        group = groups[self.piece[starts]]
        self.order = starts[np.lexsort((last[starts + least - reach], last[starts], group))]
        a, b = self.order[:-1].copy(), self.order[1:].copy()
        room = np.minimum(left[a], left[b])
        same = groups[self.piece[a]] == groups[self.piece[b]]
        common = np.zeros(len(a), dtype=np.int64)
        # longest stretches first; the longest may fit more than once
        for k in [len(levels) - 1] * (int(sizes.max(initial=0)) // reach) + list(range(len(levels) - 2, -1, -1)):
            step = 1 << k
            top = len(names) - 1
            fits = same & (common + step <= room) & (levels[k][np.minimum(a + common, top)] == levels[k][np.minimum(b + common, top)])
            common += np.where(fits, step, 0)
        self.common = np.concatenate([[0], common]) if len(self.order) else common

    def nodes(self, depth: int) -> Iterator[tuple[int, np.ndarray]]:
        """The topmost internal nodes at least so deep: the words that all suffixes below share, and these."""
        for a, b in zip(*self._stretches(depth)):
            yield int(self.common[a + 1:b].min()), self.order[a:b]

    def _stretches(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        deep = np.concatenate([self.common >= depth, [False]])
        begins = np.flatnonzero(~deep[:-1] & deep[1:])
        ends = np.flatnonzero(deep[:-1] & ~deep[1:]) + 1
        return begins, ends

    def repeated(self, depth: int) -> np.ndarray:
        """The suffixes below nodes at least so deep."""
        below = self.common >= depth
        below[:-1] |= below[1:]
        return np.sort(self.order[below])


def _stretches(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """The first and last of each stretch of consecutive numbers."""
    cuts = np.flatnonzero(np.diff(values) != 1) + 1
    for a, b in zip([0, *cuts], [*cuts, len(values)]):
        yield int(values[a]), int(values[b - 1])


def _read(docs: DataFrame, window: int) -> DataFrame:
    """Each row's text digest ``t``, counts, compressed text and the keys of its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                raw = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
                texts = [t.split() for t in raw]
                solid = [b" ".join(w) for w in texts]
                keys: list[list[np.ndarray]] = [[] for _ in texts]
                for t, _, _, found in runs(texts, window):
                    keys[t].append(found)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), pa.array([hashlib.md5(s).digest() for s in solid], type=pa.binary()),
                    pa.array([len(w) for w in texts], type=pa.int64()), pa.array([hashlib.sha256(s).hexdigest() for s in solid]),
                    pa.array([press.compress(s) for s in solid], type=pa.binary()),
                    pa.array([np.concatenate(k) if k else [] for k in keys], type=pa.list_(pa.int64()))],
                    names=["doc_id", "t", "n_words", "sha", "packed", "keys"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, t binary, n_words long, sha string, packed binary, keys array<long>")


def _pieces(rows: DataFrame, window: int) -> DataFrame:
    """A row per run of windows whose anchor is in ``wanted``; the words come once in a task for each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        seen: set[bytes] = set()
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = [unpack.decompress(p).split() for p in batch.column("packed").to_pylist()]
                names = batch.column("t").to_pylist()
                wanted = batch.column("wanted").to_pylist()
                out: list[list] = [[], [], [], [], [], []]
                for t, first, n, keys in runs(texts, window):
                    chosen = np.isin(keys, np.array(wanted[t], dtype=np.int64))
                    for a, m, key in zip(first[chosen].tolist(), n[chosen].tolist(), keys[chosen].tolist()):
                        piece = b" ".join(texts[t][a:a + m + window - 1])
                        name = xxhash.xxh128_digest(piece)
                        new = name not in seen
                        seen.add(name)
                        for column, value in zip(out, (name, key, names[t], a, m, piece if new else None)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([
                    pa.array(c, type=kind) for c, kind in zip(out, (pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()))],
                    names=["piece", "key", "t", "at", "n", "words"])

    return rows.mapInArrow(run, "piece binary, key long, t binary, at long, n long, words binary")


def _trees(pieces: DataFrame, window: int, tree_words: int) -> DataFrame:
    """``piece``, ``low``, ``high``: the stretches of windows of a piece that another start repeats.

    Groups come whole and in order, so that trees are built over as many as fit.
    """

    def found(rows: pd.DataFrame) -> pd.DataFrame:
        texts = [w.split() for w in rows["words"]]
        tree = SuffixTree(texts, rows["key"].to_numpy(), window)
        places = tree.repeated(window)
        piece = tree.piece[places]
        names, out = rows["piece"].tolist(), []
        cuts = np.searchsorted(piece, np.arange(len(texts) + 1))
        for k in np.unique(piece).tolist():
            out += [(names[k], a, b) for a, b in _stretches(places[cuts[k]:cuts[k + 1]] - tree.begins[k])]
        return pd.DataFrame(out, columns=["piece", "low", "high"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        words = 0
        for batch in batches:
            if batch.empty:
                continue
            # several tasks may have sent the same piece; they stand together
            batch = batch.drop_duplicates("piece")
            if held and held[-1]["piece"].iloc[-1] == batch["piece"].iloc[0]:
                batch = batch.iloc[1:]
                if batch.empty:
                    continue
            held.append(batch)
            words += int(batch["n"].sum()) + (window - 1) * len(batch)
            if words >= tree_words:
                rows = pd.concat(held, ignore_index=True)
                last = rows["key"] == rows["key"].iloc[-1]
                if not last.all():
                    yield found(rows[~last])
                rest = rows[last]
                held, words = [rest], int(rest["n"].sum()) + (window - 1) * len(rest)
        if held:
            yield found(pd.concat(held, ignore_index=True))

    dealt = pieces.repartition("key").sortWithinPartitions("key", "piece")
    return dealt.mapInPandas(run, "piece binary, low long, high long")


def _long_prefixes(pieces: DataFrame, window: int) -> DataFrame:
    """As ``_trees``, with the whole window as prefix: a group is one deep node, repeated if it has two leaves."""
    words = F.split(F.col("words").cast("string"), " ")
    suffixes = pieces.select("piece", "n", words.alias("w")).dropDuplicates(["piece"]).select(
        "piece", F.posexplode(F.transform(F.sequence(F.lit(1).cast("long"), F.col("n")),
                                          lambda i: F.array_join(F.slice("w", i.cast("int"), window), " "))).alias("low", "suffix"))
    suffixes = stage(suffixes)
    deep = stage(suffixes.groupBy("suffix").agg(F.count("*").alias("leaves")).where("leaves > 1").select(F.col("suffix").alias("s")))
    return suffixes.join(deep, F.col("suffix") == F.col("s"), "left_semi").select(
        "piece", F.col("low").cast("long").alias("low"), F.col("low").cast("long").alias("high"))


def repeats(read: DataFrame, window: int = WINDOW, group_pieces: int = GROUP_PIECES, tree_words: int = TREE_WORDS) -> DataFrame:
    """``t`` and ``covered``, stretches of words (low, high; high exclusive) of each text with repeated windows."""
    texts = read.groupBy("t").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.min("n_words").alias("n_words"),
                                  F.first("keys").alias("keys"))
    texts = stage(texts)
    starts = texts.select(F.xxhash64("t").alias("of"), F.explode("keys").alias("key"))
    often = stage(starts.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select(F.col("key").alias("k")))
    wanted = starts.join(often, F.col("key") == F.col("k"), "left_semi").groupBy("of").agg(F.collect_set("key").alias("wanted"))
    chosen = texts.select(F.xxhash64("t").alias("o"), F.col("t").alias("text"), "rep").join(wanted, F.col("o") == F.col("of")).select("text", "rep", "wanted")
    # one row for each different text goes on
    rows = read.select("doc_id", "t", "packed").join(chosen, (F.col("t") == F.col("text")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    pieces = stage(_pieces(rows.select("t", "packed", "wanted"), window))
    sent = pieces.where(F.col("words").isNotNull())
    large = stage(sent.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > group_pieces).select(F.col("key").alias("k")))
    by_tree = _trees(sent.join(large, F.col("key") == F.col("k"), "left_anti").select("key", "piece", "n", "words"), window, tree_words)
    by_prefix = _long_prefixes(sent.join(large, F.col("key") == F.col("k"), "left_semi"), window)
    # a piece that occurs twice is repeated from end to end
    twice = pieces.groupBy("piece").agg(F.count("*").alias("c"), F.min("n").alias("n")).where("c > 1").select(
        "piece", F.lit(0).cast("long").alias("low"), (F.col("n") - 1).alias("high"))
    deep = stage(by_tree.unionByName(by_prefix).unionByName(twice)).withColumnRenamed("piece", "p")
    in_texts = pieces.select("piece", "t", "at").join(deep, F.col("piece") == F.col("p")).select(
        "t", (F.col("at") + F.col("low")).alias("low"), (F.col("at") + F.col("high") + window).alias("high"))
    # so is a text that has a copy
    copied = texts.where((F.col("copies") > 1) & (F.col("n_words") >= window)).select("t", F.lit(0).cast("long").alias("low"), F.col("n_words").alias("high"))
    return in_texts.unionByName(copied).groupBy("t").agg(F.collect_set(F.struct("low", "high")).alias("covered"))


def without_repeats(docs: DataFrame, window: int = WINDOW, group_pieces: int = GROUP_PIECES, tree_words: int = TREE_WORDS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept``, the words that are left, joined by one space, of every row.

    A null text has no words. Repeated rows repeat each other, so of texts of at least
    ``window`` words that come twice nothing is left.
    """
    return _left(docs, window, group_pieces, tree_words, "kept string", lambda words, sha: (b" ".join(words) if words is not None else None))


def _left(docs: DataFrame, window: int, group_pieces: int, tree_words: int, column: str, shape) -> DataFrame:
    read = stage(_read(docs, window))
    covered = repeats(read, window, group_pieces, tree_words).withColumnRenamed("t", "text")
    rows = read.select("doc_id", "t", "n_words", "sha", "packed").join(covered, F.col("t") == F.col("text"), "left")
    name = column.split(" ")[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            removed, values = [], []
            for packed, sha, stretches in zip(batch.column("packed").to_pylist(), batch.column("sha").to_pylist(), batch.column("covered").to_pylist()):
                if stretches is None and name != "kept":
                    removed.append(0)
                    values.append(sha)
                    continue
                words = unpack.decompress(packed).split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for s in stretches or ():
                    gone[s["low"]] += 1
                    gone[s["high"]] -= 1
                left = np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()
                removed.append(len(words) - len(left))
                values.append(shape([words[i] for i in left], sha))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("n_words"), pa.array(removed, type=pa.int64()),
                pa.array([v.decode() if isinstance(v, bytes) else v for v in values], type=pa.string())],
                names=["doc_id", "n_words", "n_removed", name])

    return rows.select("doc_id", "n_words", "sha", "packed", "covered").mapInArrow(
        run, f"doc_id long, n_words long, n_removed long, {column}")


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated passages, as a digest."""
    return _left(table(spark, sf_dir, "documents"), WINDOW, GROUP_PIECES, TREE_WORDS, "kept_sha256 string",
                 lambda words, sha: hashlib.sha256(b" ".join(words)).hexdigest())
