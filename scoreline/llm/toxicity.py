"""Toxicity by noisy-channel deobfuscation.

A trigram model of letters is counted over all documents. Tokens with signs or digits
that can stand for letters or set them apart, wherever in the token, become lattices
of what they may stand for (numbers and words in common punctuation do not); Viterbi decoding picks the reading that model and
channel together make likeliest. The restored words, with doubled letters made one,
are looked up among words and word beginnings that the labelled documents show
to be toxic, and a logistic function of what was found is the score.

Two folds of the labelled documents choose and weigh the words, a third fits the logistic
function, and the fourth (crc32 of the id, modulo 4, is 2) is never read.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, settle

#: Fold (crc32 of the id modulo 4) that nothing is learned from, and the one that fits the last step.
HELD_OUT, FIT_FOLD = 2, 3
#: Least score of a document that is predicted toxic.
THRESHOLD = 0.3
#: Labelled documents learned from, at most; a hash of the id chooses them.
FIT_ROWS = 40_000
#: Words and beginnings kept as signs, at most.
MOST_SIGNS = 20_000
#: Least number of toxic documents with a sign, and least ratio of its shares in toxic and other documents.
LEAST_SEEN, LEAST_RATIO = 3, 8.0
#: Lengths of the word beginnings that are looked up besides whole words.
BEGINNINGS = (4, 5)

#: Tokens whose signs a worker remembers; beyond that it starts a new memory.
REMEMBERED = 120_000

# What a sign may stand for; digits and signs in the shapes of letters.
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il",
         "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "h", "%": "o"}
#: Costs (negative logarithms) of the channel's steps.
AS_LOOKED, AS_STAR, REPEATED, SEPARATED, OPENED = 1.0, 2.5, 1.5, 0.5, 1.0
SEPARATORS = " .-_*'·~^"

LETTERS = 61  # 0: no letter, 1-26: a-z, 27-59: the accented letters of Latin-1, 60: any other


def _codes() -> np.ndarray:
    table = np.zeros(0x300, np.uint8)
    for i in range(0x300):
        c = chr(i)
        if c.isalpha():
            low = ord(c.lower()[0])
            table[i] = low - 96 if 97 <= low <= 122 else low - 0xDF + 27 if 0xDF <= low <= 0xFF else 60
    return table


_CODE = _codes()


def letter_codes(text: str) -> np.ndarray:
    """The model's symbol of each character."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < len(_CODE), _CODE[np.minimum(points, len(_CODE) - 1)], np.where((points >= 0x2000) & (points < 0x3000), 0, 60))


def count_trigrams(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How often each three symbols follow each other, over all documents: at most ``LETTERS ** 3`` counts."""

    def work(batch: pa.RecordBatch) -> dict:
        codes = letter_codes("\n\n".join(["", *pc.fill_null(batch.column(text), "").to_pylist(), ""])).astype(np.int64)
        counts = np.bincount((codes[:-2] * LETTERS + codes[1:-1]) * LETTERS + codes[2:], minlength=LETTERS**3)
        counts[0] = 0
        seen = np.flatnonzero(counts)
        return {"symbols": pa.array(seen, pa.int32()), "n": pa.array(counts[seen], pa.int64())}

    made = arrow_map(docs.select(text), work, "symbols int, n bigint", text).groupBy("symbols").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(LETTERS**3)
    counts[made["symbols"].to_numpy(int)] = made["n"].to_numpy(float)
    return counts.reshape(LETTERS, LETTERS, LETTERS)


def letter_costs(counts: np.ndarray) -> np.ndarray:
    """Negative log probabilities of a symbol after two others, smoothed by pairs and single symbols."""
    single = counts.sum((0, 1)) + 1
    single = single / single.sum()
    pair = counts.sum(0)
    pair = (pair + 5 * single) / (pair.sum(1, keepdims=True) + 5)
    triple = (counts + 5 * pair) / (counts.sum(2, keepdims=True) + 5)
    return -np.log(triple).astype(np.float32)


def _symbol(letter: str) -> int:
    i = ord(letter)
    return int(_CODE[i]) if i < len(_CODE) else 60


def flat_costs(costs: np.ndarray | array) -> array:
    """The costs as one row of numbers, which plain Python reads several times as fast as a table of numpy's."""
    return costs if isinstance(costs, array) else array("d", costs.astype(np.float64).tobytes())


@lru_cache(maxsize=4096)
def _channel(character: str) -> tuple[int, tuple[tuple[int, str, float], ...], bool]:
    """A character's own symbol, the letters that it may stand for with their costs, and whether it may stand for nothing."""
    own, price = _symbol(character), AS_STAR if character == "*" else AS_LOOKED
    return own, tuple((_symbol(look), look, price) for look in LOOKS.get(character, "")), not own and (character in SEPARATORS or character not in LOOKS)


def decode(token: str, costs: np.ndarray | array) -> str:
    """The likeliest letters (blanks where words end) behind a disguised token, by Viterbi search.

    A state is the last two symbols, as one number. A character may stand for itself, for a letter
    that it looks like, for a repetition of the letter before, or, as a separator, for
    nothing or for the end of a word. Every state keeps its best reading, as a chain of
    letters that readings share, so that long tokens take time in proportion.
    """
    costs = flat_costs(costs)
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for character in token:
        own, looks, silent = _channel(character)
        made: dict[int, tuple[float, tuple | None]] = {}
        best = made.get
        for state, (cost, text) in states.items():
            last, row = state % LETTERS, state * LETTERS
            if own:
                to, total = last * LETTERS + own, cost + costs[row + own]
                if (held := best(to)) is None or total < held[0]:
                    made[to] = (total, (text, character))
                if own == last and ((held := best(state)) is None or cost + REPEATED < held[0]):
                    made[state] = (cost + REPEATED, text)
            for code, look, price in looks:
                to, total = last * LETTERS + code, cost + costs[row + code] + price
                if (held := best(to)) is None or total < held[0]:
                    made[to] = (total, (text, look))
                if code == last and ((held := best(state)) is None or cost + AS_LOOKED + REPEATED < held[0]):
                    made[state] = (cost + AS_LOOKED + REPEATED, text)
            if silent:
                if (held := best(state)) is None or cost + SEPARATED < held[0]:
                    made[state] = (cost + SEPARATED, text)
                if last:
                    total = cost + OPENED + costs[row]
                    if (held := best(0)) is None or total < held[0]:
                        made[0] = (total, (text, " "))
        states = made or states
    ends = [(cost + costs[state * LETTERS], text) for state, (cost, text) in states.items()]
    least = min(cost for cost, _ in ends)
    return min(_spelled(text) for cost, text in ends if cost == least)


def _spelled(chain: tuple | None) -> str:
    letters = []
    while chain:
        chain, letter = chain
        letters.append(letter)
    return "".join(reversed(letters))


_LETTER = "[^\\W\\d_]"
_LOOKS = re.escape("".join(LOOKS))
_LOOK = f"[{_LOOKS}]"
#: A sign that stands for no letter, and a look-alike that is a sign and no digit.
_MARK = rf"(?:[^\w{_LOOKS}]|_)"
_SIGN = re.escape("".join(c for c in LOOKS if not c.isdigit()))
#: Words in common punctuation and numbers with their signs; the lattice has no other reading of them.
_PLAIN = re.compile(rf"{_MARK}*{_LETTER}*{_MARK}*|(?:{_MARK}|[(+#$€£])*\d+(?:[.,:;/'-]\d+)*(?:{_MARK}|[%!+$€£])*")
_ENDS = [re.compile(p) for p in (rf"^(?:{_MARK}|[{_SIGN}])+", rf"(?:{_MARK}|[{_SIGN}])+$", r"^[\W\d_]+", r"[\W\d_]+$")]
_SPACED = re.compile(rf"(?<![^\W_])(?:{_LETTER}|{_LOOK})(?:[ ._*-]{{1,2}}(?:{_LETTER}|{_LOOK})){{3,}}(?![^\W_])")
#: Finds every text that the pattern above can match, by a linear scan.
_MAY_BE_SPACED = rf"(?:[\pL\pN{_LOOKS}][ ._*-]{{1,2}}){{3}}[\pL\pN{_LOOKS}]"
_WORDS = re.compile(rf"{_LETTER}+")
_DOUBLED = re.compile(r"(.)\1+")
#: Marks that often follow a word.
_BEHIND = frozenset(",.;:?)'\"")


def readings(token: str) -> list[str]:
    """The disguised token whole, and without the signs or all that is no letter at its ends, which may be punctuation."""
    begin, end, first, last = _ENDS
    opened = begin.sub("", token)
    made = dict.fromkeys([token, opened, end.sub("", token), end.sub("", opened), last.sub("", first.sub("", token))])
    return [t for t in made if not _PLAIN.fullmatch(t)]


def restored_words(token: str, costs: np.ndarray | array) -> list[str]:
    """The lower-case words of a token, read through its disguise, doubled letters as one."""
    plain = _WORDS.findall(token)
    if not _PLAIN.fullmatch(token):
        plain = [w for t in readings(token) for w in _WORDS.findall(_DOUBLED.sub(r"\1", decode(t, costs)))] + plain
    return list(dict.fromkeys(_DOUBLED.sub(r"\1", w) for w in plain))


def signs_of(words: list[str]) -> list[str]:
    """What is looked up for a token: its words and their beginnings (marked by a hyphen)."""
    found = list(words)
    for w in words:
        for n in BEGINNINGS:
            if len(w) > n:
                found.append(w[:n] + "-")
    return found if len(words) == 1 else list(dict.fromkeys(found))


class Reader(dict):
    """Signs by token, remembered; ``known`` keeps those with a weight only.

    Two generations are remembered: when the younger is full it becomes the older,
    whose tokens come back as they are met, so that frequent tokens are read once.
    """

    def __init__(self, costs: np.ndarray, known: dict[str, float] | None = None) -> None:
        super().__init__()
        self.costs, self.known, self.older = flat_costs(costs), known, {}

    def __missing__(self, token: str) -> tuple[str, ...]:
        if len(self) > REMEMBERED // 2:
            self.older = dict(self)
            self.clear()
        made = self.older.get(token)
        if made is None:
            # Most tokens are one word, as it is or with one mark behind; what the general way finds in them is that word.
            word = token if token.isalpha() else token[:-1] if token[-1:] in _BEHIND and token[:-1].isalpha() else None
            signs = signs_of([_DOUBLED.sub(r"\1", word)] if word else restored_words(token, self.costs))
            made = tuple(signs if self.known is None else [s for s in signs if s in self.known])
        self[token] = made
        return made

    def documents(self, column: pa.Array) -> list[tuple[list[tuple[str, ...]], int]]:
        """For each text the signs of its tokens (tokens without signs left out), and the number of tokens."""
        column = pc.utf8_lower(pc.fill_null(column, ""))
        spaced = pc.match_substring_regex(column, _MAY_BE_SPACED).to_numpy(zero_copy_only=False)
        out = []
        for text, apart in zip(column.to_pylist(), spaced.tolist(), strict=True):
            tokens = text.split()
            found = list(filter(None, map(self.__getitem__, tokens)))
            if apart:
                for m in _SPACED.finditer(text):
                    found += filter(None, (self[w] for w in decode(m[0], self.costs).split()))
            out.append((found, len(tokens)))
        return out


def fold_of(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)).cast("int")


def evidence(found: list[tuple[str, ...]], tokens: int, weights: dict[str, float]) -> list[float]:
    """What the logistic function sees of a document."""
    best = [max(weights[s] for s in signs) for signs in found]
    distinct = {max(signs, key=lambda s: (weights[s], s)) for signs in found}
    return [math.log1p(sum(best)), max(best, default=0.0), math.log1p(len(distinct)), sum(best) / math.sqrt(tokens + 1.0)]


class Model:
    """Letter costs, weights of signs, and the logistic function."""

    def __init__(self, costs: np.ndarray, weights: dict[str, float], beta: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> None:
        self.costs, self.weights, self.beta, self.centre, self.scale = costs, weights, beta, centre, scale

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.beta[0] + (x - self.centre) / self.scale @ self.beta[1:], -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients (constant first) with a quadratic penalty, and the centre and scale of x; one class alone gives its share."""
    if not len(x):
        return np.array([-3.0, 0, 0, 0, 0]), np.zeros(4), np.ones(4)
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.hstack([np.ones((len(x), 1)), (x - centre) / scale])
    beta, ridge = np.zeros(z.shape[1]), np.diag([1e-3, *[penalty] * x.shape[1]])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        move = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge, z.T @ (y - p) - ridge @ beta)
        beta += np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    return beta, centre, scale


def _count_signs(labelled: DataFrame, costs, text: str, only: dict[str, float] | None) -> DataFrame:
    """Documents by sign; ``only`` limits the signs."""

    def work(batch: pa.RecordBatch) -> dict:
        reader, counts = Reader(costs.value, only), Counter()
        for found, _ in reader.documents(batch.column(text)):
            counts.update({s for signs in found for s in signs})
        return {"sign": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())}

    return arrow_map(labelled.select(text), work, "sign string, n bigint", text).groupBy("sign").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", most: int = FIT_ROWS) -> Model:
    """Fit on all texts (letters) and at most about ``most`` labelled ones (signs and weights)."""
    spark = docs.sparkSession
    costs = letter_costs(count_trigrams(docs, text))
    shared = spark.sparkContext.broadcast(costs)
    known = labels.where(F.col("toxic").isin(0, 1) & F.col(key).isNotNull()).select(
        F.col(key).alias("_id"), F.col("toxic").cast("int").alias("_toxic"), fold_of(F.col(key)).alias("_fold"))
    known = known.where(F.col("_fold") != HELD_OUT).groupBy("_id").agg(F.max("_toxic").alias("_toxic"), F.first("_fold").alias("_fold"))
    share = min(1.0, most / max(known.count(), 1))
    # About ``most`` rows of three numbers.
    chosen = F.broadcast(known.where(F.pmod(F.xxhash64(F.lit(11), "_id"), F.lit(1_000_000)) < int(share * 1_000_000)))
    rows = settle(docs.select(F.col(key).alias("_key"), F.col(text)).join(chosen, F.col("_key") == F.col("_id")).select("_toxic", "_fold", text).repartition(
        spark.sparkContext.defaultParallelism), "labelled")
    choose = rows.where(F.col("_fold") != FIT_FOLD)
    n_toxic, n_other = (choose.where(F.col("_toxic") == v).count() for v in (1, 0))
    toxic = _count_signs(choose.where("_toxic = 1"), shared, text, None).where(F.col("n") >= LEAST_SEEN)
    seen = {r["sign"]: r["n"] for r in toxic.orderBy(F.desc("n"), "sign").limit(10 * MOST_SIGNS).collect()}
    other = {r["sign"]: r["n"] for r in _count_signs(choose.where("_toxic = 0"), shared, text, seen).collect()}
    weights = {}
    for sign, n in seen.items():
        low = max(n - math.sqrt(n), 1.0) / (n_toxic + 1)
        ratio = low / ((other.get(sign, 0) + 0.5) / (n_other + 1))
        if ratio >= LEAST_RATIO:
            weights[sign] = math.log(ratio)
    weights = dict(sorted(weights.items(), key=lambda w: (-w[1], w[0]))[:MOST_SIGNS])
    known_signs = spark.sparkContext.broadcast(weights)

    def features(batch: pa.RecordBatch) -> dict:
        found = Reader(shared.value, known_signs.value).documents(batch.column(text))
        return {"toxic": batch.column("_toxic"), "x": pa.array([evidence(f, n, known_signs.value) for f, n in found], pa.list_(pa.float64()))}

    # At most about a third of ``most`` rows of four numbers.
    fit = arrow_map(rows.where(F.col("_fold") == FIT_FOLD).select("_toxic", text), features, "toxic int, x array<double>", text).toPandas()
    x = np.array(fit["x"].tolist(), dtype=float).reshape(-1, 4)
    return Model(costs, weights, *fit_logistic(x, fit["toxic"].to_numpy(float)))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, held_out, score, predicted, n_signs.

    The score depends on the text alone. NULL and empty texts get the score of a text
    without signs; texts of any length are read whole; equal texts score alike. A NULL
    key is not held out. An empty input gives no rows. Extra columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch, cache: dict = {}) -> dict:  # noqa: B006  one reader for each task
        own = shared.value
        reader = cache.get("reader") or cache.setdefault("reader", Reader(own.costs, own.weights))
        found = reader.documents(batch.column(text))
        made = own.score(np.array([evidence(f, n, own.weights) for f, n in found], dtype=float).reshape(-1, 4))
        return {"id": batch.column(key), "score": pa.array(made), "n_signs": pa.array([len(f) for f, _ in found], pa.int64())}

    scored = arrow_map(docs.select(key, text), work, f"id {dict(docs.dtypes)[key]}, score double, n_signs bigint", text)
    return scored.select(F.col("id").alias(key), F.coalesce(fold_of(F.col("id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "n_signs")


def op1_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
