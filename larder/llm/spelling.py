"""Spelling variants: words one edit apart, found by grams of variable length.

At each place of a word, between marks for its start and end, a gram begins with ``SHORTEST``
characters and is lengthened while it is frequent, up to ``LONGEST``; grams inside another are
left out. The dictionary holds the frequent grams alone, so it is pruned by frequency and its
size is bounded by the number of characters over that frequency.

Whether a gram that ends at ``e`` is kept depends on the ``LONGEST`` characters before ``e`` and on
nothing else. One edit therefore affects at most as many grams of a word as end within
``LONGEST`` places behind some place of it: the word's bound. All others occur in the other word too, at
the same place or, behind an inserted character, one later. Of any ``bound + 1`` grams at least one is thus
shared, and if both words take theirs in the same order, rarest first, their lists
share one. Only those lists are merged, by gram, place and length; long lists come last in the
order and are mostly never read. What meets is verified. Pairs of words whose bounds are no
less than their numbers of grams meet by all strings with one character left out.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import ship, stage, table
from larder.llm.grouped import tiled

# Fixed by the contract.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[a-zÀ-ÿ]"
DAMAGED = 31
LEAST_LENGTH, LEAST_ROWS = 7, 2
TIMES = 10

SHORTEST, LONGEST = 3, 4
FREQUENT = 500  # words with a gram above which it is lengthened
DICTIONARY = 1_000_000  # no more grams than this
TILE = 4096
_PAIRS = 2_000_000  # pairs verified at a time
_START, _END = 0x110000, 0x110001
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of the runs of letters, some of them with a character deleted, as the contract has it.

    Null texts have none; a null doc_id is the empty text.
    """
    low = F.translate("text", UPPER, LOWER)
    # runs that are too short stay so
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(low, F.lit(f"{RUN}{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"))
    chance = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = (chance % F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    words = runs.select(F.when(chance % DAMAGED == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_ROWS)


def _codes(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words by length: their places in the list and their characters between the two marks."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        codes = np.empty((len(at), length + 2), dtype=np.uint64)
        codes[:, 0], codes[:, -1] = _START, _END
        if length:
            codes[:, 1:-1] = np.array([words[i] for i in at], dtype=f"U{length}").view(np.uint32).reshape(-1, length)
        yield at, codes


def _grams(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash of the gram of so many characters at each place, 0 for none; that of a gram does not depend on its word."""
    hashes = np.zeros(codes.shape, dtype=np.uint64)
    if codes.shape[1] >= width:
        n = codes.shape[1] - width + 1
        for j in range(width):
            hashes[:, :n] = hashes[:, :n] * _ODD[0] + codes[:, j:j + n] + np.uint64(1)
    return hashes


def _mix(*parts: np.ndarray) -> np.ndarray:
    out = np.zeros((), dtype=np.uint64)
    for part, odd in zip(parts, _ODD[1:]):
        out = (out ^ np.asarray(part).astype(np.uint64)) * odd
        out = out ^ (out >> np.uint64(29))
    return out


def gram_dictionary(words: DataFrame, frequent: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the frequent grams, in order, and how often each occurs.

    At most DICTIONARY of them: with more characters, a gram has to be more frequent.
    """
    ship(words.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [h[h != 0] for _, codes in _codes(batch.column("word").to_pylist())
                     for h in (_grams(codes, q) for q in range(SHORTEST, LONGEST + 1))]
            grams, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n)], names=["gram", "n"])

    places = words.agg(F.coalesce(F.sum(F.length("word") + 2), F.lit(0))).first()[0]
    least = max(frequent, -(-places * (LONGEST - SHORTEST + 1) // DICTIONARY))
    counts = words.select("word").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = counts.where(F.col("n") > least).toPandas()
    grams = rows["gram"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(grams)
    return grams[order], rows["n"].to_numpy(dtype=np.int64)[order]


def decompose(codes: np.ndarray, dictionary: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For words of one length, at each place: is a gram kept, its hash, how frequent it is (0: rare), where it ends."""
    known, counts = dictionary
    m, n = codes.shape
    hashes, often, ends = np.zeros((m, n), np.uint64), np.zeros((m, n), np.int64), np.zeros((m, n), np.int64)
    for q in range(SHORTEST, min(LONGEST, n) + 1):
        places = n - q + 1
        found = _grams(codes, q)[:, :places]
        if len(known):
            at = np.minimum(np.searchsorted(known, found), len(known) - 1)
            frequent = np.where(known[at] == found, counts[at], 0)
        else:
            frequent = np.zeros(found.shape, np.int64)
        longer = np.ones(found.shape, bool) if q == SHORTEST else (often[:, :places] > 0) & (ends[:, :places] == np.arange(places) + q - 1)
        hashes[:, :places][longer] = found[longer]
        often[:, :places][longer] = frequent[longer]
        ends[:, :places][longer] = np.broadcast_to(np.arange(places) + q, found.shape)[longer]
    kept = ends > 0
    kept[:, 1:] &= ends[:, 1:] > np.maximum.accumulate(ends, axis=1)[:, :-1]
    return kept, hashes, often, ends


def bounds(kept: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """At most how many of a word's grams one edit affects."""
    m, n = kept.shape
    most = np.zeros(m, dtype=np.int64)
    for p in range(1, n - 1):
        most = np.maximum(most, (kept & (ends - LONGEST <= p) & (p < ends)).sum(axis=1))
    return most


def _postings(words: list[str], dictionary: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Places of words in the list, keys, whether it looks for words one longer, and how frequent the gram is."""
    rows, keys, probes, often = [], [], [], []

    def add(row: np.ndarray, key: np.ndarray, probe: bool, frequent: np.ndarray | int = 0) -> None:
        rows.append(row)
        keys.append(key)
        probes.append(np.full(len(row), probe))
        often.append(np.broadcast_to(frequent, len(row)))

    for at, codes in _codes(words):
        n = codes.shape[1]
        kept, hashes, frequent, ends = decompose(codes, dictionary)
        bound, total = bounds(kept, ends), kept.sum(axis=1)
        # rarest first, the same for all words; equal grams by place
        order = np.lexsort((np.broadcast_to(np.arange(n), kept.shape), hashes, frequent, ~kept), axis=1)
        row, place = np.nonzero(np.arange(n) < np.minimum(bound + 1, total)[:, None])
        place = order[row, place]
        gram, share = hashes[row, place], frequent[row, place]
        add(at[row], _mix(gram, place, np.full(len(row), n)), False, share)
        for later in (0, 1):
            add(at[row], _mix(gram, place + later, np.full(len(row), n + 1)), True, share)
        loose = np.flatnonzero(bound >= total)
        if len(loose):
            own = codes[loose]
            whole = _grams(own, n)[:, 0]
            add(at[loose], _mix(whole, np.full(len(loose), -1), np.full(len(loose), n + 1)), True)
            for p in range(1, n - 1):
                left = _grams(np.delete(own, p, axis=1), n - 1)[:, 0]
                add(at[loose], _mix(left, np.full(len(loose), -1), np.full(len(loose), n)), False)
                add(at[loose], _mix(left, np.full(len(loose), -1 - p), np.full(len(loose), n)), False)
    if not rows:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))
    return np.concatenate(rows), np.concatenate(keys).view(np.int64), np.concatenate(probes), np.concatenate(often)


def postings(words: DataFrame, dictionary: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """key, probe, often, word, n: the lists of each word's rarest grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, key, probe, often = _postings(batch.column("word").to_pylist(), dictionary)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(probe), pa.array(often), batch.column("word").take(at), batch.column("n").take(at)],
                names=["key", "probe", "often", "word", "n"])

    return words.select("word", F.col("n").cast("long").alias("n")).mapInArrow(run, "key long, probe boolean, often long, word string, n long")


def _spans(new: np.ndarray, second: np.ndarray, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the range of later rows that it meets, in groups sorted by (second, probe).

    ``new`` marks the first rows of groups. Rows of one tile all meet; those of two meet across. Two probes never do.
    """
    group = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(new))
    firsts = np.bincount(group, weights=~second, minlength=len(starts)).astype(np.int64)
    lists = np.bincount(group, weights=second & ~probe, minlength=len(starts)).astype(np.int64)
    two = (starts + firsts < ends)[group]
    middle = (starts + firsts)[group]
    row = np.arange(len(new))
    low = np.where(two, middle, row + 1)
    high = np.where(two, np.where(probe, middle + lists[group], ends[group]), np.where(probe, row + 1, ends[group]))
    return low, np.where(two & second, low, np.maximum(high, low))


def verified(words: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of words are exactly one inserted, deleted or replaced character apart."""
    width = max(1, words.dtype.itemsize // 4) + 1
    codes = words.astype(f"U{width}").view(np.uint32).reshape(-1, width)
    size = (codes != 0).sum(axis=1)
    bits = np.bitwise_or.reduce(np.where(codes != 0, np.uint64(1) << ((codes.astype(np.uint64) * _ODD[0]) >> np.uint64(58)), np.uint64(0)), axis=1)
    apart = np.abs(size[i] - size[j])
    # an edit takes away one letter at most and adds one at most
    near = np.flatnonzero((apart <= 1) & (np.bitwise_count(bits[i] ^ bits[j]) <= 2 - apart))
    found = np.zeros(len(i), dtype=bool)
    for at in range(0, len(near), 1 << 17):
        some = near[at:at + (1 << 17)]
        swap = size[i[some]] > size[j[some]]
        a, b = codes[np.where(swap, j[some], i[some])], codes[np.where(swap, i[some], j[some])]
        same = a == b
        begin = np.where(same.all(axis=1), width, np.argmin(same, axis=1))[:, None]
        later = np.arange(width - 1) >= begin
        shifted = (~later | (a[:, :-1] == b[:, 1:])).all(axis=1)
        found[some] = np.where(apart[some] == 0, (~same).sum(axis=1) == 1, shifted)
    return found


def _links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links within whole groups, each both ways: word, near, near_n."""
    rows = rows.sort_values(["key", "one", "two", "second", "probe"], kind="stable")
    new = np.ones(len(rows), dtype=bool)
    new[1:] = False
    for key in ("key", "one", "two"):
        values = rows[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    words, n = rows["word"].to_numpy(dtype="U"), rows["n"].to_numpy()
    low, high = _spans(new, rows["second"].to_numpy(dtype=bool), rows["probe"].to_numpy(dtype=bool))
    size, probe = np.char.str_len(words), rows["probe"].to_numpy(dtype=bool)
    out = []
    total = np.cumsum(high - low)
    at = 0
    while at < len(rows):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _PAIRS, side="right")))
        many = high[at:end] - low[at:end]
        i = np.repeat(np.arange(at, end), many)
        j = np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low[at:end], many)
        # lists meet at equal lengths, a probe meets the list of words one longer
        fit = size[i] - size[j] == probe[j].astype(np.int64) - probe[i]
        i, j = i[fit], j[fit]
        hit = verified(words, i, j)
        out.append((i[hit], j[hit]))
        at = end
    i, j = (np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in (0, 1))
    a, b = np.concatenate([i, j]), np.concatenate([j, i])
    return pd.DataFrame({"word": words[a], "near": words[b], "near_n": n[b]})


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of a partition sorted by group; holds a batch and one group."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if rows.empty:
            continue
        last = rows.iloc[-1]
        open_ = (rows["key"] == last["key"]) & (rows["one"] == last["one"]) & (rows["two"] == last["two"])
        rest = rows[open_.to_numpy()]
        done = rows[~open_.to_numpy()]
        if len(done):
            yield _links(done)
    if rest is not None:
        yield _links(rest)


def near_words(words: DataFrame, frequent: int = FREQUENT, tile: int = TILE) -> DataFrame:
    """``word``, ``near``, ``near_n`` of all pairs of different words one edit apart, each pair both ways.

    ``words`` has distinct words and their ``n``. Lists of up to ``tile`` rows are merged as they are; longer ones,
    which only grams that frequent can have, are cut into tiles that meet in pairs.
    """
    listed = postings(words, gram_dictionary(words, frequent))
    heavy = F.col("often") * 3 > tile
    one_tile = listed.where(~heavy).select(
        "key", "probe", "word", "n", F.lit(0).cast("long").alias("one"), F.lit(0).cast("long").alias("two"), F.lit(False).alias("second"))
    many = tiled(listed.where(heavy).select("key", "probe", "word", "n", F.lit(0).alias("band")), ["key"], "band", 0, "word", tile).drop("band")
    order = ["key", "one", "two"]
    dealt = one_tile.unionByName(many).repartition(*order).sortWithinPartitions(*order)
    return dealt.mapInPandas(_stream, "word string, near string, near_n long").distinct()


def variants(words: DataFrame, frequent: int = FREQUENT, tile: int = TILE) -> DataFrame:
    """Each word's spelling: word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest n, ties by code point, if its n is at least ten times the word's. Words are
    distinct and not null; no words give no rows. Writes words and forms in the shared folder.
    """
    words = stage(words.select("word", F.col("n").cast("long").alias("n")))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word"))).alias("best")
    near = near_words(words, frequent, tile).groupBy(F.col("word").alias("w")).agg(F.count("*").alias("n_near"), best)
    is_form = -F.col("best.less") >= TIMES * F.col("n")
    named = stage(words.join(near, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")))
    # n grows tenfold at each step of a chain, so a few doublings reach its end
    most = named.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log2(math.log10(most) + 1)))
    roots = named.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(steps):
        ends = roots.select(F.col("word").alias("w"), F.col("root").alias("r"))
        roots = stage(roots.join(ends, F.col("root") == F.col("w"), "left").select("word", F.coalesce("r", "root").alias("root")))
    roots = roots.withColumnRenamed("word", "w")
    return named.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return variants(vocabulary(table(spark, sf_dir, "documents").select("doc_id", "text")))
