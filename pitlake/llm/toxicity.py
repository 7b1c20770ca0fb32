"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney models of word sequences, one of toxic and one of
ordinary labelled documents.  Pairs of words have raw counts, words the number
of distinct words before them (continuation counts), and below both lies one
distribution that the classes share: the words of all documents.

    P_c(w | h) = max(n_c(h w) - D, 0) / N_c(h) + G_c(h) P_c(w)
    P_c(w)     = max(k_c(w) - D', 0) / K_c + L_c S(w)
    S(w)       = (c(w) + PRIOR) / (C + PRIOR (V + 1))

n: counts of pairs, k: distinct words before w, c: counts in all documents (C
words, V different ones), D, D': absolute discounts, G_c(h) and L_c: the mass
that discounting leaves, so each sums to one.  Pairs seen less than ``PAIRS``
times in both classes together leave their mass to P_c(w).  What neither class
has seen costs both the same shared counts, and a rare expression is judged by
them: PRIOR keeps a word of few occurrences from saying much.

A word that no labelled document holds is judged by its letters: the same
kind of model over ``ORDER`` letters, down to the letter pairs of all
documents, normalised by the word's length.

A document is compared by length-normalised differences of the two
log-likelihoods, over the whole text and over its most toxic ``WINDOWS``
words; a logistic curve fitted to labelled documents that the models haven't
seen turns these into a score from 0 to 1.  Then the word models are counted
again over all labelled documents but those held out.

Every labelled document counts: those whose residue is 0 or 1 for the models
and the letters, those of residue 3 for the curve and, after it, the models.
The shared counts cover all words of all documents, in a table that grows with
them.  Counts are tables of Spark; the finished ratios of the words, frequent
pairs and letters that labelled documents hold go to every worker, so their
size follows the vocabulary of these.  Letters are bytes of UTF-8; words are lower-cased and cut at ASCII
punctuation, and told apart by 64-bit hashes.

Documents are read twice: once for the shared counts and the labelled texts,
once to score.

Defined results: null and empty texts score like a text that says nothing; a
document with two labels is toxic if one says so; labels without both classes
give everyone the share of the class there is; null doc_ids are never held out.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, Scratch, WordHashes, loose_words, mix, release, row_count_at_most, short_batches, signed, table

#: Rounds in which pairs are counted, so that the disk holds one round's shuffle and pairs at a time.
PAIR_ROUNDS = 4
#: Different words whose counts a task holds before it passes them on.
HELD_WORDS = 200_000
#: Labels that are broadcast, and rows that the curve is fitted to on the driver; more of either stay in Spark.
LABELS_SENT = 1_000_000
FIT_ROWS = 200_000
ORDER = 6
SHARED = 2
WINDOWS = (1, 3, 12, 48)
PRIOR = 20.0
PAIRS = 4
THRESHOLD = 0.3
_EDGE = 32  # between words
_PAD = bytes([_EDGE]) * (ORDER - 1)


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ``ORDER`` letters up to each letter of each word and up to its end, packed; where each word's begin."""
    letters = np.frombuffer(_PAD + _PAD.join(words) + b" ", dtype=np.uint8)
    packed = letters.astype(np.int64)
    for back in range(1, ORDER):
        packed[back:] |= letters[:-back].astype(np.int64) << (8 * back)
    inside = letters != _EDGE
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    starts = np.flatnonzero(~inside[:-1] & inside[1:]) + 1
    use = inside.copy()
    use[ends] = True
    place = np.cumsum(use) - 1
    return packed[use], place[starts]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each different key and the sum of its counts."""
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, weights=np.concatenate(counts), minlength=len(key)).astype(np.int64)


def class_counts(labelled: DataFrame) -> DataFrame:
    """``labelled``: text, toxic (0 or 1).  Rows: gram of letters long, n_t, n_o."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counter(), Counter()

        def out():
            keys, counts = [], []
            for toxic, words in enumerate(held):
                if words:
                    packed, starts = grams(list(words))
                    keys.append(packed * 2 + toxic)
                    counts.append(np.repeat(np.fromiter(words.values(), np.int64, len(words)), np.diff(np.append(starts, len(packed)))))
                    words.clear()
            gram, n = _summed(keys, counts)
            return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], names=["gram", "n"])

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[int(toxic)].update(loose_words(text))
            if len(held[0]) + len(held[1]) > HELD_WORDS:
                yield out()
        if held[0] or held[1]:
            yield out()

    out = labelled.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(run, "gram long, n long")
    toxic = F.col("gram") % 2 == 1
    of = lambda x: F.sum(F.when(x, F.col("n")).otherwise(0))
    return out.groupBy(F.shiftright("gram", 1).alias("gram")).agg(of(toxic).alias("n_t"), of(~toxic).alias("n_o"))


_GATHERED = "kind int, key long, n long, text string, toxic int, fold int"
_WORD, _LETTERS, _LABELLED = range(3)


def gathered(docs: DataFrame, labels: DataFrame, most: int = LABELS_SENT) -> DataFrame:
    """One pass over all documents: how often each word and each pair of letters came (counted by task), and the labelled texts.

    ``labels``: doc_id, toxic, fold; broadcast where they are at most ``most``.
    """
    labels = F.broadcast(labels) if row_count_at_most(labels, most) else labels
    rows = docs.select("doc_id", "text").join(labels, "doc_id", "left").select("text", "toxic", "fold")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(kind: int, **columns) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            columns["kind"] = np.full(n, kind)
            schema = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64()), ("text", pa.string()), ("toxic", pa.int32()), ("fold", pa.int32())])
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

        hashes, total, held, size, keys, counts = WordHashes(), np.zeros(1 << 16, dtype=np.int64), [], 0, [], []

        def summed() -> None:
            key, n = np.unique(np.concatenate(held), return_counts=True)
            key, n = _summed([*keys, key], [*counts, n])
            keys[:], counts[:] = [key], [n]
            held.clear()

        for batch in batches:
            labelled: list[tuple] = []
            some: list[list[bytes]] = []
            for text, toxic, fold in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if words := loose_words(text):
                    some.append(words)
                if fold is not None:
                    labelled.append((text, toxic, fold))
            if some:
                words = list(chain.from_iterable(some))
                held.append(hashes.of(words))
                size += len(words)
                for i in range(0, len(words), 50_000):
                    letters = np.frombuffer(b" " + b" ".join(words[i : i + 50_000]) + b" ", dtype=np.uint8).astype(np.uint16)
                    total += np.bincount((letters[:-1] << 8) | letters[1:], minlength=1 << 16)
            if labelled:
                text, toxic, fold = zip(*labelled)
                yield out(_LABELLED, text=text, toxic=toxic, fold=fold)
            if size > 2_000_000:
                summed()
                size = 0
                if len(keys[0]) > 4 * HELD_WORDS:
                    yield out(_WORD, key=signed(keys.pop()), n=counts.pop())
        if held:
            summed()
        if keys:
            yield out(_WORD, key=signed(keys.pop()), n=counts.pop())
        pair = np.flatnonzero(total)
        if len(pair):
            yield out(_LETTERS, key=pair, n=total[pair])

    return rows.mapInArrow(run, _GATHERED)


def letter_pairs(found: DataFrame) -> np.ndarray:
    """How often each letter follows each other one in the words of all documents: 256 by 256."""
    counts = found.where(F.col("kind") == _LETTERS).groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # 65,536 rows at most
    out = np.zeros(1 << 16)
    out[counts["key"].to_numpy()] = counts["n"].to_numpy()
    return out.reshape(256, 256)


def pair_counts(labelled: DataFrame, part: int = 0, parts: int = 1) -> DataFrame:
    """``labelled``: text, toxic, fold (0 or 1).  Rows: h, w (hashes of neighbours, 0 before the first word), t_0, o_0, t_1, o_1.

    Pairs are dealt out to ``parts`` by their first word, and one of these is counted, whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            words = [loose_words(t) for t in batch.column(0).to_pylist()]
            kind = np.array([int(toxic) + 2 * int(fold) for toxic, fold in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())], dtype=np.int32)
            length = np.fromiter(map(len, words), np.int64, len(words))
            w = hashes.of(list(chain.from_iterable(words)))
            if len(w):
                h, kind = np.append(U64(0), w[:-1]), np.repeat(kind, length)
                h[(np.cumsum(length) - length)[length > 0]] = 0
                if parts > 1:
                    mine = h % U64(parts) == part
                    h, w, kind = h[mine], w[mine], kind[mine]
                yield pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(signed(w)), pa.array(kind)], names=["h", "w", "kind"])

    of = lambda kind: F.sum(F.when(F.col("kind") == kind, 1).otherwise(0))
    return labelled.select("text", "toxic", "fold").mapInArrow(run, "h long, w long, kind int").groupBy("h", "w").agg(of(1).alias("t_0"), of(0).alias("o_0"), of(3).alias("t_1"), of(2).alias("o_1"))


def _seen(columns: list[str]) -> list:
    """Aggregates: how many were seen once and twice, and ever, and the sum."""
    of = lambda c: (F.count(F.when(F.col(c) == 1, 1)), F.count(F.when(F.col(c) == 2, 1)), F.count(F.when(F.col(c) > 0, 1)), F.sum(c))
    return [x.alias(f"{c}_{name}") for c in columns for name, x in zip(("one", "two", "some", "sum"), of(c))]


def _discounts(seen, columns: list[str]) -> list[float]:
    """The usual estimate of each column's absolute discount."""
    return [float(np.clip(seen[f"{c}_one"] / (seen[f"{c}_one"] + 2 * seen[f"{c}_two"]), 0.1, 0.95)) if seen[f"{c}_one"] and seen[f"{c}_two"] else 0.75 for c in columns]


@dataclass
class Probabilities:
    """Both classes' models as tables; a class that has no words makes ``known`` false."""

    known: bool
    left: tuple[float, float] = (1.0, 1.0)  # L of toxic, ordinary
    words: DataFrame | None = None  # w, s, p_t, p_o
    histories: DataFrame | None = None  # h, n_t, n_o (counts), g_t, g_o
    pairs: DataFrame | None = None  # h, w, p_t, p_o


def shared_size(shared: DataFrame) -> float:
    """What the shared counts (key, n) are divided by."""
    every = shared.agg(F.sum("n").alias("c"), F.count(F.lit(1)).alias("v")).first()
    return float(every["c"] or 0) + PRIOR * (every["v"] + 1)


@dataclass
class PairSums:
    """What models need of counted pairs.  Each column of counts makes its own."""

    words: DataFrame  # w; distinct words before it that have a count
    histories: DataFrame  # h; sums.  Of histories with a pair in ``often``
    often: DataFrame  # h, w; the pairs seen ``PAIRS`` times or more in the last two columns
    seen: Counter  # of pairs, by the names of ``_seen``


def pair_sums(counts: DataFrame, columns: list[str], scratch: Scratch, name: str) -> PairSums:
    """``counts``: h, w and ``columns``; all pairs of a history are there.  The sums don't read ``counts`` again."""
    together = F.col(columns[-2]) + F.col(columns[-1])
    words = scratch.stage(counts.groupBy("w").agg(*(F.count(F.when(F.col(c) > 0, 1)).alias(c) for c in columns)), f"{name}_words")
    histories = counts.groupBy("h").agg(*(F.sum(c).alias(c) for c in columns), F.max(together).alias("most")).where(F.col("most") >= PAIRS).drop("most")
    histories = scratch.stage(histories, f"{name}_histories")
    often = scratch.stage(counts.where(together >= PAIRS).select("h", "w", *columns), f"{name}_often")
    seen = counts.agg(*_seen(columns)).first().asDict()
    return PairSums(words, histories, often, Counter({k: n or 0 for k, n in seen.items()}))


def with_shares(words: DataFrame, shared: DataFrame, size: float) -> DataFrame:
    """``words`` and s, the share of each w in all documents."""
    return words.join(shared.withColumnRenamed("key", "w"), "w", "left").withColumn("s", (F.coalesce("n", F.lit(0)) + PRIOR) / size).drop("n")


def models_of(sums: PairSums, t: str, o: str, scratch: Scratch, name: str) -> Probabilities:
    """The models of the columns ``t`` and ``o``; the words of ``sums`` have shares."""
    words = sums.words.select("w", "s", F.col(t).alias("k_t"), F.col(o).alias("k_o")).where("k_t + k_o > 0")
    seen = words.agg(*_seen(["k_t", "k_o"])).first()
    if not seen["k_t_sum"] or not seen["k_o_sum"]:
        return Probabilities(False)
    left, p = [], {}
    for c, d in zip(("k_t", "k_o"), _discounts(seen, ["k_t", "k_o"])):
        left.append(d * seen[f"{c}_some"] / seen[f"{c}_sum"])
        p[c] = F.greatest(F.col(c) - d, F.lit(0.0)) / float(seen[f"{c}_sum"]) + left[-1] * F.col("s")
    known = words.select("w", "s", p["k_t"].alias("p_t"), p["k_o"].alias("p_o"))
    d_t, d_o = _discounts(sums.seen, [t, o])
    often = sums.often.select("h", "w", F.col(t).alias("c_t"), F.col(o).alias("c_o")).where(F.col("c_t") + F.col("c_o") >= PAIRS)
    kept = lambda c, d: F.sum(F.greatest(F.col(c) - d, F.lit(0.0)))
    g = lambda k, n: F.when(F.col(n) > 0, 1 - F.col(k) / F.col(n)).otherwise(1.0)
    histories = often.groupBy("h").agg(kept("c_t", d_t).alias("kept_t"), kept("c_o", d_o).alias("kept_o")).where("kept_t > 0 or kept_o > 0")
    histories = histories.join(sums.histories.select("h", F.col(t).alias("n_t"), F.col(o).alias("n_o")), "h")
    histories = scratch.stage(histories.select("h", "n_t", "n_o", g("kept_t", "n_t").alias("g_t"), g("kept_o", "n_o").alias("g_o")), f"{name}_downs")
    of = lambda c, d, k: F.when(F.col(f"N_{k}") > 0, F.greatest(F.col(c) - d, F.lit(0.0)) / F.col(f"N_{k}")).otherwise(0.0) + F.col(f"g_{k}") * F.col(f"p_{k}")
    totals = histories.select("h", F.col("n_t").alias("N_t"), F.col("n_o").alias("N_o"), "g_t", "g_o")
    with_totals = often.join(totals, "h").join(known, "w")
    return Probabilities(True, (left[0], left[1]), known, histories, with_totals.select("h", "w", of("c_t", d_t, "t").alias("p_t"), of("c_o", d_o, "o").alias("p_o")))


def word_models(counts: DataFrame, shared: DataFrame, size: float, scratch: Scratch, name: str) -> Probabilities:
    """``counts``: h, w, n_t, n_o.  ``shared``: key, n of all documents' words, and their ``shared_size``."""
    sums = pair_sums(counts, ["n_t", "n_o"], scratch, name)
    sums.words = scratch.stage(with_shares(sums.words, shared, size), f"{name}_shares")
    return models_of(sums, "n_t", "n_o", scratch, name)


def summed_in_rounds(labelled: DataFrame, shared: DataFrame, size: float, scratch: Scratch, rounds: int = PAIR_ROUNDS) -> PairSums:
    """The sums of all pairs, f_t and f_o without those of fold 1, n_t and n_o with them.  A round's pairs are deleted once they are summed."""
    columns = {"f_t": F.col("t_0"), "f_o": F.col("o_0"), "n_t": F.col("t_0") + F.col("t_1"), "n_o": F.col("o_0") + F.col("o_1")}
    parts = []
    for k in range(rounds):
        pairs = scratch.stage(pair_counts(labelled, k, rounds).select("h", "w", *(x.alias(c) for c, x in columns.items())), f"pairs_{k}")
        release(scratch.spark)
        parts.append(pair_sums(pairs, [*columns], scratch, f"sums_{k}"))
        scratch.drop(f"pairs_{k}")
    every = lambda part: functools.reduce(DataFrame.unionByName, (getattr(x, part) for x in parts))
    words = every("words").groupBy("w").agg(*(F.sum(c).alias(c) for c in columns))
    words = scratch.stage(with_shares(words, shared, size), "shares")
    scratch.drop("words", *(f"sums_{k}_words" for k in range(rounds)))
    release(scratch.spark)
    return PairSums(words, every("histories"), every("often"), sum((x.seen for x in parts), Counter()))


@dataclass
class WordRatios:
    """log P_toxic - log P_ordinary of words and pairs of words, the step down below a history, and below everything."""

    word: np.ndarray  # sorted hashes
    ratio: np.ndarray
    pair: np.ndarray  # sorted keys of pairs
    pair_ratio: np.ndarray
    history: np.ndarray  # sorted hashes
    down: np.ndarray
    unseen: float


def pair_key(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(h + U64(1)) + w)


def word_ratios(p: Probabilities) -> WordRatios:
    """The models as arrays: as many numbers as the labelled documents have words and frequent pairs."""

    def of(df: DataFrame, t: str, o: str, *keys: str) -> tuple[np.ndarray, np.ndarray]:
        rows = df.select(*keys, F.log(F.col(t) / F.col(o)).cast("float").alias("ratio")).toArrow()
        key = [rows[k].to_numpy().view(U64) for k in keys]
        key = key[0] if len(key) == 1 else pair_key(*key)
        order = np.argsort(key)
        return key[order], rows["ratio"].to_numpy()[order]

    return WordRatios(*of(p.words, "p_t", "p_o", "w"), *of(p.pairs, "p_t", "p_o", "h", "w"), *of(p.histories, "g_t", "g_o", "h"), float(np.log(p.left[0] / p.left[1])))


@dataclass
class Level:
    """What the grams of one order add: the whole difference of a known gram, the step down below a known history."""

    gram: np.ndarray  # sorted
    ratio: np.ndarray
    history: np.ndarray  # sorted
    down: np.ndarray


def _discount(n: np.ndarray) -> float:
    """The usual estimate from how many were seen once and twice."""
    one, two = int((n == 1).sum()), int((n == 2).sum())
    return float(np.clip(one / (one + 2 * two), 0.1, 0.95)) if one and two else 0.75


def ratio_levels(gram: np.ndarray, n_t: np.ndarray, n_o: np.ndarray, shared: np.ndarray) -> list[Level]:
    """log P_toxic - log P_ordinary, the longest order first."""
    order = np.argsort(gram)
    counts = [(gram[order], n_t[order].astype(float), n_o[order].astype(float))]
    for k in range(ORDER - 1, SHARED, -1):  # distinct letters before, in each class
        longer, t, o = counts[-1]
        short, at = np.unique(longer & ((1 << (8 * k)) - 1), return_inverse=True)
        counts.append((short, np.bincount(at, weights=t > 0, minlength=len(short)), np.bincount(at, weights=o > 0, minlength=len(short))))
    by_letter = shared.sum(axis=0) + 0.5
    by_letter /= by_letter.sum()
    below = (shared + 2 * by_letter) / (shared.sum(axis=1, keepdims=True) + 2)
    lower, levels = None, []
    for k in range(SHARED + 1, ORDER + 1):
        g, *n = counts[ORDER - k]
        history, h = np.unique(g >> 8, return_inverse=True)
        if lower is None:
            base = below[(g >> 8) & 255, g & 255]
            p_below = [base, base]
        else:
            at = np.searchsorted(lower[0], g & ((1 << (8 * (k - 1))) - 1))
            p_below = [p[at] for p in lower[1:]]
        p, down = [], []
        for c in (0, 1):
            d = _discount(n[c])
            total = np.bincount(h, weights=n[c], minlength=len(history))
            after = np.bincount(h, weights=n[c] > 0, minlength=len(history))
            step = np.where(total > 0, d * after / np.maximum(total, 1), 1.0)
            p.append(np.where(total[h] > 0, np.maximum(n[c] - d, 0) / np.maximum(total[h], 1), 0.0) + step[h] * p_below[c])
            down.append(step)
        lower = (g, *p)
        levels.append(Level(g, np.log(p[0] / p[1]), history, np.log(down[0] / down[1])))
    return levels[::-1]


class Scorer(dict):
    """Word -> its difference by its letters."""

    LIMIT = 150_000

    def __init__(self, levels: list[Level]):
        super().__init__()
        self.levels = levels

    def learn(self, words: list[bytes]) -> None:
        packed, starts = grams(words)
        out, left = np.zeros(len(packed)), np.arange(len(packed))
        for k, level in zip(range(ORDER, SHARED, -1), self.levels):
            g = packed[left] & ((1 << (8 * k)) - 1)
            i = np.minimum(np.searchsorted(level.gram, g), len(level.gram) - 1)
            hit = level.gram[i] == g
            out[left[hit]] += level.ratio[i[hit]]
            left, g = left[~hit], g[~hit] >> 8
            if not len(left):
                break
            i = np.minimum(np.searchsorted(level.history, g), len(level.history) - 1)
            hit = level.history[i] == g
            out[left[hit]] += level.down[i[hit]]
        self.update(zip(words, np.add.reduceat(out, starts).tolist()))


class Directory:
    """Values by hash.  The first bits of a hash tell where it stands, if it is there."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(1, len(keys).bit_length())
        self.keys, self.values, self.shift = keys, values, U64(64 - bits)
        self.start = np.append(0, np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << bits).cumsum())

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places in ``wanted`` of those that are known, and the values of these."""
        slot = (wanted >> self.shift).astype(np.int64)
        at, end = self.start[slot], self.start[slot + 1]
        left = np.flatnonzero(at < end)
        at, end, wanted = at[left], end[left], wanted[left]
        places, found = [left[:0]], [left[:0]]
        while len(left):
            hit = self.keys[at] == wanted
            places.append(left[hit])
            found.append(at[hit])
            more = ~hit
            more &= at + 1 < end
            left, at, end, wanted = left[more], at[more] + 1, end[more], wanted[more]
        return np.concatenate(places), self.values[np.concatenate(found)]


class _Places(dict):
    """Word -> its number, given at its first use; ``new`` lists those that got one."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class WordScorer:
    """The features of texts.  Words met are kept with their numbers, up to a bound."""

    LIMIT = 150_000

    def __init__(self, ratios: WordRatios, levels: list[Level]):
        self.letters, self.unseen = Scorer(levels), ratios.unseen
        self.words, self.pairs, self.histories = Directory(ratios.word, ratios.ratio), Directory(ratios.pair, ratios.pair_ratio), Directory(ratios.history, ratios.down)
        self.first_key = mix(np.array([1], dtype=U64))[0]
        self.first_down = float(sum(self.histories.find(np.zeros(1, dtype=U64))[1]))
        self._clear()

    def _clear(self) -> None:
        self.place = _Places()
        self.hashes = self.key = np.zeros(0, dtype=U64)
        self.alone = self.below = np.zeros(0, dtype=np.float32)
        self.letters.clear()

    def _learn(self, words: list[bytes]) -> None:
        hashes = WordHashes().of(words)
        alone = np.empty(len(words), dtype=np.float32)
        hit, ratio = self.words.find(hashes)
        alone[hit] = ratio
        unseen = np.ones(len(words), dtype=bool)
        unseen[hit] = False
        unseen = np.flatnonzero(unseen)
        if len(unseen):
            some = [words[i] for i in unseen]
            self.letters.learn(some)
            alone[unseen] = [self.unseen + self.letters[w] / (len(w) + 1) for w in some]  # the letters and the end
            self.letters.clear()
        below = np.zeros(len(words), dtype=np.float32)
        hit, down = self.histories.find(hashes)
        below[hit] = down
        self.hashes = np.concatenate((self.hashes, hashes))
        self.key = np.concatenate((self.key, mix(hashes + U64(1))))
        self.alone, self.below = np.concatenate((self.alone, alone)), np.concatenate((self.below, below))

    def differences(self, at: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of each word after the one before it, or after none at the places ``first``; ``at``: numbers of known words."""
        out, down, key = self.alone[at].astype(float), np.zeros(len(at)), np.zeros(len(at), dtype=U64)
        down[1:], key[1:] = self.below[at[:-1]], self.key[at[:-1]]
        down[first], key[first] = self.first_down, self.first_key
        out += down
        hit, ratio = self.pairs.find(mix(key + self.hashes[at]))
        out[hit] = ratio
        return out

    def features(self, texts: list[str | None]) -> np.ndarray:
        """For each text: its most toxic words, the whole text, its length."""
        words = [loose_words(t) for t in texts]
        if len(self.place) > self.LIMIT:
            self._clear()
        ends = np.cumsum([len(x) for x in words])
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(words)), np.int64, int(ends[-1]) if len(ends) else 0)
        new, self.place.new = self.place.new, []
        for i in range(0, len(new), 50_000):
            self._learn(new[i : i + 50_000])
        out = np.zeros((len(texts), len(WINDOWS) + 2))
        if not len(at):
            return out
        begin = ends - [len(x) for x in words]
        every = self.differences(at, begin[begin < ends])
        for row, i, j in zip(out, begin.tolist(), ends.tolist()):
            if i == j:
                continue
            x = every[i:j]
            most = min(WINDOWS[-1], len(x))
            top = np.sort(np.partition(x, len(x) - most)[len(x) - most :])[::-1].cumsum()
            for k, size in enumerate(WINDOWS):
                size = min(size, most)
                row[k] = top[size - 1] / size
            row[-2:] = x.mean(), np.log1p(len(x))
        return out


_FEATURES = [*(f"__x_{w}" for w in WINDOWS), "__x_all", "__x_length"]


def _features(docs: DataFrame, models, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with the features of its text."""
    rows = docs.select(*keep) if "text" in keep else docs.select(*keep, "text")
    at = rows.columns.index("text")
    schema = T.StructType([*rows.schema.fields[: len(keep)], *(T.StructField(c, T.DoubleType()) for c in _FEATURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = WordScorer(*models.value)  # its words go with the task
        for batch in batches:
            x = scorer.features(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *(pa.array(x[:, i]) for i in range(len(_FEATURES)))], names=[*keep, *_FEATURES])

    return rows.mapInArrow(run, schema)


def _curve_sums(x: np.ndarray, y: np.ndarray, mean: np.ndarray, scale: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Newton's sums over some rows: the second derivatives and, last, the first."""
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
    return np.vstack([z.T @ (z * (p * (1 - p))[:, None]), z.T @ (y - p)])


def fit_curve(rows: DataFrame, most: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Logistic regression by Newton's method on standardised features; (mean, scale, weights), none without both classes.

    ``rows``: toxic and the features, staged.  Up to ``most`` are fetched; of more only sums reach the driver, a small matrix a task.
    """
    found = rows.agg(F.min("toxic").alias("low"), F.max("toxic").alias("high"), *(f(c).alias(f"{c}_{n}") for c in _FEATURES for n, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    if found["low"] == found["high"]:
        return None
    mean, scale = (np.array([found[f"{c}_{n}"] for c in _FEATURES]) + e for n, e in (("m", 0.0), ("s", 1e-9)))
    arrays = lambda t: (np.column_stack([t[c].to_numpy(zero_copy_only=False) for c in _FEATURES]), t["toxic"].to_numpy(zero_copy_only=False).astype(float))
    if row_count_at_most(rows, most):
        local = arrays(rows.select("toxic", *_FEATURES).orderBy("toxic", *_FEATURES).toArrow().combine_chunks().to_batches()[0])
        sums = lambda beta: _curve_sums(*local, mean, scale, beta)
    else:

        def sums(beta: np.ndarray) -> np.ndarray:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                total = sum((_curve_sums(*arrays(batch), mean, scale, beta) for batch in batches if batch.num_rows), np.zeros((len(beta) + 1, len(beta))))
                yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()])], names=["sums"])

            parts = rows.select("toxic", *_FEATURES).mapInArrow(run, "sums array<double>").select(F.spark_partition_id().alias("part"), "sums").collect()
            return sum(np.array(r["sums"]) for r in sorted(parts)).reshape(len(beta) + 1, len(beta))

    beta = np.zeros(len(_FEATURES) + 1)
    penalty = np.diag([0.0, *[0.1] * len(_FEATURES)])
    for _ in range(100):
        *second, first = sums(beta)
        step = np.linalg.solve(np.array(second) + penalty + 1e-9 * np.eye(len(beta)), first - penalty @ beta)
        beta += step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, beta


def residue(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def _scored(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` and __score.  Labels of documents whose residue is 2 are never read."""
    spark = docs.sparkSession
    short_batches(spark)
    scratch = Scratch(spark, "toxicity")
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("__r", residue())
    used = known.where(F.col("__r") != 2).select("doc_id", "toxic", F.when(F.col("__r") == 3, 1).otherwise(0).alias("fold"))
    found = scratch.split(gathered(docs, used), "gathered", "kind", 3)
    labelled = found.where(F.col("kind") == _LABELLED).select("text", "toxic", "fold")
    shared = scratch.stage(found.where(F.col("kind") == _WORD).groupBy("key").agg(F.sum("n").alias("n")), "words")
    scratch.drop(f"gathered/kind={_WORD}")
    release(spark)
    sums = summed_in_rounds(labelled, shared, shared_size(shared), scratch)
    first = models_of(sums, "f_t", "f_o", scratch, "first")
    if not first.known:
        share = known.where(F.col("__r") != 2).agg(F.avg("toxic")).first()[0] or 0.0
        return docs.select(*keep, F.lit(float(share)).alias("__score"))
    # as many grams as the words of labelled documents have
    letters = class_counts(labelled.where("fold = 0")).toArrow()
    levels = ratio_levels(*(letters[c].to_numpy() for c in ("gram", "n_t", "n_o")), letter_pairs(found))
    models = spark.sparkContext.broadcast((word_ratios(first), levels))
    curve = fit_curve(scratch.stage(_features(labelled.where("fold = 1"), models, ["toxic"]), "curve"))
    models.unpersist()
    mean, scale, beta = curve or (np.zeros(len(_FEATURES)), np.ones(len(_FEATURES)), np.array([-4.0, 1.0, *[0.0] * (len(_FEATURES) - 1)]))
    scratch.drop("gathered")
    both = models_of(sums, "n_t", "n_o", scratch, "both")
    models = spark.sparkContext.broadcast((word_ratios(both), levels))
    scratch.drop("")
    z = F.lit(float(beta[0] - (beta[1:] * mean / scale).sum()))
    for c, a in zip(_FEATURES, (beta[1:] / scale).tolist()):
        z = z + F.col(c) * a
    z = F.least(F.lit(30.0), F.greatest(F.lit(-30.0), z))
    return _features(docs, models, keep).select(*keep, (1 / (1 + F.exp(-z))).alias("__score"))


def score(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns of ``docs`` (all but its text by default) with held_out, score and predicted, which replace columns of these names."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("text", "held_out", "score", "predicted")]
    held_out = F.coalesce(residue() == 2, F.lit(False))
    out = _scored(docs, labels, keep)
    return out.select(*keep, held_out.alias("held_out"), F.col("__score").alias("score"), F.when(F.col("__score") >= threshold, 1).otherwise(0).alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic."""
    return _scored(docs, labels, docs.columns).where(F.col("__score") < threshold).select(*docs.columns)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
