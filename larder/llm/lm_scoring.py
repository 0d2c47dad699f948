"""Log-probabilities of texts by a log-bilinear model trained with noise contrast.

A token's symbol is the word itself if it is frequent enough, else a class given by the
word's ending; the end of a text is a symbol too. The context vector, a linear map of
the vector of the symbol before, is multiplied with the vectors of all symbols; softmax over these
products gives the symbol's probability, and a rare word's own probability within its class
follows from smoothed counts. So all tokens' probabilities sum to one, but for the
smoothing's one place for words never seen.

Training sees every training token: what it needs of them are the counts of symbol
pairs, one matrix of fixed size, and its noise term is summed over all symbols instead
of drawn. Words beyond the ``FREQUENT`` ones, whose counts every task holds, are looked up by a join.
"""

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import most_frequent, stage, table

# Fixed by the contract: one document in FOLDS is held out; the smoothing of counts.
FOLDS = 10
SMOOTH = 0.1
FREQUENT = 200_000  # words whose counts every task holds, at most; bounds what is broadcast
SYMBOLS = 1024
CLASSES = 127
WORDS = SYMBOLS - CLASSES - 1  # the most frequent words are symbols of their own
END = SYMBOLS - 1
RANK = 48
NOISE = 25
STEPS = 250
_FLUSH = 400_000


def word_class(word: bytes) -> int:
    """The class of a rare word, from its last two bytes."""
    return zlib.crc32(word[-2:]) % CLASSES


class Model(NamedTuple):
    """What scoring needs, of fixed size."""

    words: list[bytes]  # the frequent words, most frequent first
    counts: np.ndarray  # their training counts
    end: int  # training count of the end
    tokens: int  # N
    distinct: int  # V
    class_tokens: np.ndarray  # of rare words, by class
    class_words: np.ndarray
    table: np.ndarray  # log10 probability of each symbol after each symbol


def held_out() -> Column:
    """Whether a row is held out; rows without an id are."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def count_words(docs: DataFrame) -> DataFrame:
    """``word``, ``class``, ``n`` of all words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([
                pa.array(list(counts), type=pa.binary()).cast(pa.string()), pa.array([word_class(w) for w in counts], type=pa.int32()),
                pa.array(list(counts.values()), type=pa.int64())], names=["word", "class", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                counts.update((text or b"").lower().split())
                if len(counts) > _FLUSH:
                    yield out()
        yield out()

    rows = docs.select("text").mapInArrow(run, "word string, class int, n long")
    return rows.groupBy("word", "class").agg(F.sum("n").alias("n"))


class _Ids(dict):
    """A word's place among the frequent ones; -1 less its class for others."""

    def __missing__(self, word: bytes) -> int:
        return -1 - word_class(word)


def _ids(texts: list[bytes | None], ids: _Ids) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each text; ids of all words, one after the other; where each text's words begin."""
    words = [(t or b"").lower().split() for t in texts]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    found = np.fromiter(map(ids.__getitem__, chain.from_iterable(words)), dtype=np.int64, count=int(sizes.sum()))
    return words, found, sizes


def _symbols(ids: np.ndarray, classes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of the texts, each with its end, those before them, and where each text begins."""
    own = np.where(ids < 0, WORDS - 1 - ids, ids)
    # frequent words that are not symbols have their class
    among = (ids >= WORDS)
    own[among] = WORDS + classes[ids[among]]
    symbols = np.insert(own, np.cumsum(sizes), END)
    before = np.concatenate([[END], symbols[:-1]])
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    return symbols, before, begins


def count_pairs(docs: DataFrame, words: list[bytes]) -> np.ndarray:
    """How often each symbol follows each symbol in all texts. A task sends each pair once at most."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids((w, i) for i, w in enumerate(shared.value))
        classes = np.array([word_class(w) for w in shared.value], dtype=np.int64)
        pairs = np.zeros(SYMBOLS * SYMBOLS, dtype=np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                texts = whole.slice(at, 512).column("text").cast(pa.binary()).to_pylist()
                _, found, sizes = _ids(texts, ids)
                symbols, before, _ = _symbols(found, classes, sizes)
                pairs += np.bincount(before * SYMBOLS + symbols, minlength=len(pairs))
        at = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(pairs[at])], names=["pair", "n"])

    sums = docs.select("text").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SYMBOLS * SYMBOLS)
    out[sums["pair"].to_numpy()] = sums["n"].to_numpy()
    return out.reshape(SYMBOLS, SYMBOLS)


def train(pairs: np.ndarray, steps: int = STEPS, rank: int = RANK, noise: int = NOISE, seed: int = 3) -> np.ndarray:
    """Log10 probabilities of each symbol after each, normalised, from the model trained on pair counts.

    Noise contrast tells each pair from ``noise`` pairs of the same context with
    symbols drawn by their frequency; the sum over all such draws is its expectation.
    """
    rng = np.random.default_rng(seed)
    n = len(pairs)
    total = max(1.0, pairs.sum())
    drawn = (pairs.sum(axis=0) + 0.5) / (pairs.sum() + 0.5 * n)
    data = (pairs / total).astype(np.float32)
    context = (pairs.sum(axis=1) / total).astype(np.float32)
    against = noise * context[:, None] * drawn[None, :].astype(np.float32)
    offset = np.log(noise * drawn).astype(np.float32)
    params = {
        "vectors": rng.normal(0, 0.1, (n, rank)), "map": np.eye(rank) + rng.normal(0, 0.01, (rank, rank)),
        "outputs": rng.normal(0, 0.1, (n, rank)), "bias": np.log(drawn)}
    params = {k: v.astype(np.float32) for k, v in params.items()}
    means, squares = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2))
    for step in range(1, steps + 1):
        mapped = params["vectors"] @ params["map"]
        scores = mapped @ params["outputs"].T + params["bias"]
        chance = 1 / (1 + np.exp(np.clip(offset - scores, -60, 60)))
        slope = against * chance - data * (1 - chance)
        back = slope @ params["outputs"]
        slopes = {"bias": slope.sum(axis=0), "outputs": slope.T @ mapped, "map": params["vectors"].T @ back, "vectors": back @ params["map"].T}
        rate = 0.05 * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in slopes.items():
            means[k] += 0.1 * (g - means[k])
            squares[k] += 0.01 * (g * g - squares[k])
            params[k] -= rate * (means[k] / (1 - 0.9**step)) / (np.sqrt(squares[k] / (1 - 0.99**step)) + 1e-12)
    scores = (params["vectors"] @ params["map"] @ params["outputs"].T + params["bias"]).astype(np.float64)
    scores -= scores.max(axis=1, keepdims=True)
    return (scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))) / np.log(10)


def fit(docs: DataFrame, frequent: int = FREQUENT) -> tuple[Model, DataFrame]:
    """The model of all texts, and the counts of all their words as a table."""
    counts = stage(count_words(docs))
    ends = docs.count()
    top = most_frequent(counts, frequent).select("word", "n").toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    words = [w.encode() for w in top["word"].to_pylist()]
    own = docs.sparkSession.createDataFrame([(w.decode(),) for w in words[:WORDS]], "w string")
    rare = counts.join(own, F.col("word") == F.col("w"), "left_anti").groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in rare:
        class_tokens[r["class"]], class_words[r["class"]] = r["n"], r["v"]
    model = Model(words, top["n"].to_numpy(), ends, tokens + ends, distinct + bool(ends), class_tokens, class_words, train(count_pairs(docs, words)))
    return model, counts


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``base_score``, ``score`` (log10) of every row.

    A null text is an empty one; it still has its end. Tasks sum up what they know;
    words beyond the frequent ones are looked up in ``counts``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        ids = _Ids((w, i) for i, w in enumerate(m.words))
        classes = np.array([word_class(w) for w in m.words], dtype=np.int64)
        log_counts = np.log10(m.counts + SMOOTH)
        # by place of the word, then by class from the end, then the end of a text
        within = -np.log10(m.class_tokens + SMOOTH * (m.class_words + 1))
        base = -np.log10(m.tokens + SMOOTH * (m.distinct + 1))
        end = np.log10(m.end + SMOOTH)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                words, found, sizes = _ids(batch.column("text").cast(pa.binary()).to_pylist(), ids)
                symbols, before, begins = _symbols(found, classes, sizes)
                places = np.repeat(np.arange(len(words)), sizes)
                sums = lambda values: np.bincount(places, weights=values, minlength=len(words))
                known = found >= 0
                by_count = np.zeros(len(found))
                by_count[known] = log_counts[found[known]]
                inside = np.zeros(len(found))
                classed = ~known | (found >= WORDS)
                of_class = np.where(known, classes[np.maximum(found, 0)] if len(classes) else 0, -1 - found)
                inside[classed] = (by_count + within[of_class])[classed]
                scores = np.add.reduceat(m.table[before, symbols], begins) + sums(inside)
                rare: list[Counter] = [Counter() for _ in words]
                starts = np.cumsum(sizes) - sizes
                for i, d in zip(np.flatnonzero(~known).tolist(), places[~known].tolist()):
                    rare[d][words[d][i - starts[d]]] += 1
                bounds = np.cumsum([0, *map(len, rare)])
                structs = pa.StructArray.from_arrays([
                    pa.array([w for r in rare for w in r], type=pa.binary()).cast(pa.string()),
                    pa.array([n for r in rare for n in r.values()], type=pa.int64())], names=["word", "n"])
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), pa.array(sizes + 1), pa.array(sums(known).astype(np.int64) + bool(m.end)),
                    pa.array(sums(by_count) + end + base * (sizes + 1)), pa.array(scores),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), structs)],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score", "rare"])

    parts = docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, base_score double, score double, rare array<struct<word:string,n:long>>")
    # rows get their numbers once, as they are written
    parts = stage(parts.withColumn("row", F.monotonically_increasing_id()))
    asked = parts.select("row", F.inline("rare"))
    seen = counts.select(F.col("word").alias("w"), F.col("n").alias("c"))
    looked = asked.join(seen, F.col("word") == F.col("w"), "left").groupBy(F.col("row").alias("r")).agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + SMOOTH)).alias("logs"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"))
    logs = F.coalesce("logs", F.lit(0.0))
    return parts.drop("rare").join(looked, F.col("row") == F.col("r"), "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        (F.col("base_score") + logs).alias("base_score"), (F.col("score") + logs).alias("score"))


def op4_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Scores of every document by the model of those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, counts = fit(docs.where(~held_out()))
    return score(docs, model, counts).select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
