"""Language identification: words first, letters for words never seen.

Training counts every word of every labelled text per language. A word of the table is
scored by its log frequency in each language. A word that is not in the table is read
letter by letter: from every place the longest known run of letters counts, four letters
if known, else three, two, one; each step down costs the same in all languages, so only
the frequencies of the runs tell them apart. Runs are counted over the distinct words of the
table's source, as a word never seen is one more distinct word.

Tables are counted over all labelled rows and then hold the ``MOST_WORDS`` most frequent words and,
per length, the ``MOST_RUNS`` most frequent runs; all others take the way of unseen words. That
bounds what is broadcast: at most (MOST_WORDS + 4 * MOST_RUNS) rows of ``MOST_LANGUAGES`` numbers.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import arrow_map, settle, slices

#: Entries of the tables, and languages, at most; more languages are an error.
MOST_WORDS = 100_000
MOST_RUNS = 50_000
MOST_LANGUAGES = 500
LONGEST_RUN = 4
#: Added to every count of a table before the logarithm.
SMOOTHING = 0.5
#: Fold (crc32 of the id modulo 4) that nothing is learned from.
HELD_OUT = 2
UNDETERMINED = "und"
#: Bytes of words a worker remembers the scores of.
_REMEMBERED = 32 << 20
#: Distinct words a task counts before it writes them.
_FLUSH = 200_000
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str | None) -> list[str]:
    """Runs of letters with their marks, lower-cased; composed first, so that one letter has one form."""
    return _WORD.findall(unicodedata.normalize("NFC", text or "").lower())


def runs_of(word: str) -> Iterator[list[str]]:
    """From each place of the word between its edges, the runs of letters, the longest first."""
    edged = f"\x02{word}\x03"
    for at in range(len(edged) - 1):
        yield [edged[at:at + n] for n in range(min(LONGEST_RUN, len(edged) - at), 0, -1)]


class Model:
    """Log frequencies per language: of words, and of runs by length."""

    def __init__(self, languages: list[str], documents: list[int], words: dict[str, list[int]], runs: dict[int, dict[str, list[int]]]) -> None:
        self.languages = languages
        self.prior = np.log(np.array(documents, float) / max(sum(documents), 1)) if languages else np.zeros(0)
        self.word_row, self.words = self._table(words)
        # A run of n letters counts for one of them, as n runs share a letter.
        tables = [(n, *self._table(runs.get(n, {}))) for n in range(1, LONGEST_RUN + 1)]
        names = [run for _, rows, _ in tables for run in rows]
        self.run_row = {run: i for i, run in enumerate(names)}
        self.runs = np.concatenate([table / n for n, _, table in tables])

    def _table(self, counts: dict[str, list[int]]) -> tuple[dict[str, int], np.ndarray]:
        table = np.array(list(counts.values()), float).reshape(len(counts), len(self.languages)) + SMOOTHING
        return {name: i for i, name in enumerate(counts)}, np.log(table / table.sum(axis=0)) if len(counts) else table

    def unseen(self, word: str) -> np.ndarray:
        """The score of a word that is not in the table: from each place the longest known run."""
        edged, known, rows = f"\x02{word}\x03", self.run_row, []
        for at in range(len(edged) - 1):
            for n in range(LONGEST_RUN, 0, -1):
                # Near the end a longer slice is a shorter run, which is met again.
                row = known.get(edged[at:at + n])
                if row is not None:
                    rows.append(row)
                    break
        return self.runs[np.array(rows, np.int64)].sum(axis=0)


class Reader(dict):
    """Row numbers of words in a growing table of scores; forgets the unseen ones when they take too much room."""

    def __init__(self, model: Model) -> None:
        super().__init__(model.word_row)
        self.model, self.table, self.used, self.room = model, model.words, len(model.word_row), _REMEMBERED

    def __missing__(self, word: str) -> int:
        if self.used == len(self.table):
            self.table = np.concatenate([self.table, np.zeros((max(1024, len(self.table) // 2), len(self.model.languages)))])
        self.table[self.used] = self.model.unseen(word)
        self[word] = self.used
        self.used += 1
        self.room -= 200 + len(word) + 8 * len(self.model.languages)
        return self.used - 1

    def score(self, text: str | None) -> tuple[str, float]:
        """The language and its probability; ties go to the first in alphabetical order."""
        words = words_of(text)
        if not words or not self.model.languages:
            return UNDETERMINED, 0.0
        if self.room < 0:
            self.clear()
            self.__init__(self.model)
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        # Counted first, so that the sum does not depend on what a worker has read before.
        row, first, n = np.unique(rows, return_index=True, return_counts=True)
        order = np.argsort(first)
        total = self.model.prior + (self.table[row[order]] * n[order, None]).sum(axis=0)
        best = int(np.argmax(total))
        return self.model.languages[best], float(1.0 / np.exp(total - total[best]).sum())


def _count(docs: DataFrame, text: str) -> DataFrame:
    """lang, word, n: the words of all rows of (lang, ``text``)."""
    ship_package(docs.sparkSession)

    def rows(counts: dict[str, Counter]) -> pa.RecordBatch:
        flat = [(lang, word, n) for lang, found in counts.items() for word, n in found.items()]
        columns = zip(*flat, strict=True) if flat else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], ["lang", "word", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for piece in slices(batch, text):
                for lang, value in zip(piece.column("lang").to_pylist(), piece.column(text).to_pylist(), strict=True):
                    counts.setdefault(lang, Counter()).update(words_of(value))
                if sum(map(len, counts.values())) > _FLUSH:
                    yield rows(counts)
                    counts = {}
        yield rows(counts)

    found = docs.mapInArrow(work, "lang string, word string, n bigint")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _count_runs(words: DataFrame) -> DataFrame:
    """lang, length, run, n: the runs of the distinct words of each language."""
    def work(batch: pa.RecordBatch) -> dict:
        counts = Counter((lang, run) for lang, word in zip(batch.column("lang").to_pylist(), batch.column("word").to_pylist(), strict=True)
                         for tried in runs_of(word) for run in tried)
        return {"lang": pa.array([k[0] for k in counts], pa.string()), "length": pa.array([len(k[1]) for k in counts], pa.int32()),
                "run": pa.array([k[1] for k in counts], pa.string()), "n": pa.array(list(counts.values()), pa.int64())}

    found = arrow_map(words.select("lang", "word"), work, "lang string, length int, run string, n bigint", "word", 1 << 20)
    return found.groupBy("lang", "length", "run").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, name: str, most: int, languages: list[str]) -> dict[str, list[int]]:
    """The entries with the largest total (ties by the entry), each with its count per language: at most ``most`` rows."""
    total = F.sum("n").alias("total")
    sums = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"l{i}") for i, lang in enumerate(languages)]
    # Written first: the rows are chosen by a task, not from what every task sends to the driver.
    rows = settle(counts.groupBy(name).agg(total, *sums).orderBy(F.col("total").desc(), name).limit(most).drop("total"), "frequent")
    return {r[0]: list(r[1:]) for r in rows.collect()}


def fold_of(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)).cast("int")


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          most_words: int = MOST_WORDS, most_runs: int = MOST_RUNS) -> Model:
    """Count the texts with a language whose key is not held out (a NULL key is not); NULL texts teach the share of their language only."""
    rows = docs.where(F.col(lang).isNotNull() & F.coalesce(fold_of(F.col(key)) != HELD_OUT, F.lit(True)))
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    shares = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(shares) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = [r["lang"] for r in shares]
    words = settle(_count(rows, "text"), "words")
    runs = settle(_count_runs(words), "runs")
    return Model(languages, [r["n"] for r in shares], _most_frequent(words, "word", most_words, languages),
                 {n: _most_frequent(runs.where(F.col("length") == n), "run", most_runs, languages) for n in range(1, LONGEST_RUN + 1)})


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, held_out, lang_pred, score.

    The prediction depends on the whole text alone; equal texts are predicted alike. NULL, empty and other
    texts without a letter, and all texts if nothing was learned, give ``und`` with score 0. Equal
    scores go to the first language in alphabetical order. A NULL key is not held out.
    Repeated rows stay; an empty input gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch, cache: dict = {}) -> dict:  # noqa: B006  one reader for each task
        reader = cache.get("reader") or cache.setdefault("reader", Reader(shared.value))
        found = [reader.score(t) for t in batch.column(text).to_pylist()]
        return {"id": batch.column(key), "lang_pred": pa.array([f[0] for f in found], pa.string()), "score": pa.array([f[1] for f in found], pa.float64())}

    scored = arrow_map(docs.select(key, text), work, f"id {dict(docs.dtypes)[key]}, lang_pred string, score double", text)
    return scored.select(F.col("id").alias(key), F.coalesce(fold_of(F.col("id")) == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op11_language(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs))
