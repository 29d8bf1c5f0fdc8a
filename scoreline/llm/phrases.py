"""Collocations: phrases of two to four words that keep together, per language.

1. ``encode`` reads the texts once: words are counted, and texts become rows of word codes (XXH64; the
   counted words are checked for equal codes, and another seed is taken if there are any).
2. ``heavy_cells`` counts hashes of all phrases in cells, half as many as words; a cell's count is at least that of each of
   its phrases, so a phrase as frequent as asked lies in a cell that is. ``occurrences`` gathers from every text position
   the words that may begin such a phrase there: the longest whose parts all lie in such cells. Equal ones become one row
   with their number. Of the phrases they begin with, ``candidates``, one stays (Apriori) only if what remains of it
   without its first and without its last word stayed.
3. ``count`` deals candidates and occurrences out by their first two words, puts the candidates of each part, about
   ``TRIE_PHRASES`` at most, into a double-array trie, and advances the states of all its occurrences at once, word by word;
   the accepting states are counted by ``bincount``. Every occurrence meets one trie, so that more phrases mean more
   tries, but no more work for each position.
4. ``collocations`` scores them by DataFrame joins.

Cells grow with the input and are merged segment by segment; of the heavy ones, bits whose number follows theirs are
broadcast. The codes are read twice, whatever the number of cells and phrases.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from . import sketch
from .common import settle, shuffles_dropped, slices
from .rolling import mix
from .sketch import pack_gaps, unpack_gaps

LONGEST = 4
LEAST = 30
#: A phrase goes if a longer one that holds it has this share of its count, in hundredths.
ABSORBED = 80
TOP = 2000
#: Phrases of one trie, and heavy cells whose number the broadcast bits follow; with more, more occurrences pass, and none is lost.
TRIE_PHRASES = 200_000
HEAVY_CELLS = 128_000_000
#: Parts at least that phrases are counted in.
_SHARDS = 64
#: Positions of a row of codes, and positions a task works on at a time.
_ROW = 192
_STEP = 1 << 18
_SEGMENT_BITS = 20
_FLUSH_HASHES = 2_000_000
_FLUSH_WORDS = 100_000
#: Occurrences that a task holds before it merges equal ones.
_FLUSH_ROWS = 500_000
#: First bits of the hash of two words, by which occurrences are dealt out to be merged.
_PAIR_BITS = 12
_CHUNK = 1 << 20
_SEEDS = 8
#: Parts that a language's phrases are ranked in before they are ranked together.
_PARTS = 64

_TOKEN = re.compile(rb"[.,;:!?\x0A-\x0D]|[^\x20\x09.,;:!?\x0A-\x0D]+")
_EDGE = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
_BREAKS = frozenset(bytes([c]) for c in b".,;:!?\n\x0b\x0c\r")
_CODES = [f"c{i}" for i in range(1, LONGEST + 1)]


class _Words(dict):
    """Numbers of words by order of appearance, with their codes; 0 is a break."""

    def __init__(self, seed: int) -> None:
        super().__init__({b: 0 for b in _BREAKS})
        self.seed, self.names, self.codes = seed, [b""], [0]

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh64_intdigest(word, self.seed) or 1
        self[word] = len(self.names)
        self.names.append(word)
        self.codes.append(code - (1 << 64) if code >> 63 else code)
        return len(self.names) - 1


def _chunks(data: bytes) -> Iterator[bytes]:
    """The text in parts of about a megabyte that do not cut a word."""
    at = 0
    while at < len(data):
        edge = _EDGE.search(data, at + _CHUNK)
        end = edge.end() if edge else len(data)
        yield data[at:end]
        at = end


def encode(docs: DataFrame, text: str = "text", lang: str = "lang", seed: int = 0) -> DataFrame:
    """Rows of two kinds: lang, word, code, n (counts of a part of the input), and lang, codes (with ``LONGEST - 1`` of what follows, 0 at the end)."""
    ship_package(docs.sparkSession)
    names = ["lang", "word", "code", "n", "codes"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def rows(*columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def counted(words: _Words, counts: dict) -> Iterator[pa.RecordBatch]:
        for lang, n in counts.items():
            seen = np.flatnonzero(n)
            found = [words.names[i].decode() for i in seen.tolist()]
            yield rows([lang] * len(seen), found, np.array(words.codes)[seen], n[seen], [None] * len(seen))

    def coded(lang: str, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.arange(0, len(codes), _ROW)
        padded = np.concatenate([codes, np.zeros(LONGEST - 1, np.int64)])
        ends = np.minimum(starts + _ROW, len(codes)) + LONGEST - 1
        sizes = ends - starts
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        flat = padded[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)]
        nothing = [None] * len(starts)
        yield rows([lang] * len(starts), nothing, nothing, nothing, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = _Words(seed), {}
        for batch in batches:
            for piece in slices(batch, "text"):
                texts: dict[str, list[bytes]] = {}
                for own, value in zip(piece.column("lang").to_pylist(), piece.column("text").to_pylist(), strict=True):
                    if value:
                        texts.setdefault(own, []).append(value.encode().lower())
                for own, found in texts.items():
                    parts = [np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens))
                             for tokens in map(_TOKEN.findall, _chunks(b"\n".join(found)))]
                    numbers = np.concatenate(parts)
                    n, before = np.bincount(numbers, minlength=len(words.names)), counts.get(own, np.zeros(0, np.int64))
                    n[0] = 0
                    n[:len(before)] += before
                    counts[own] = n
                    yield from coded(own, np.array(words.codes)[numbers])
                if len(words) > _FLUSH_WORDS:
                    yield from counted(words, counts)
                    words, counts = _Words(seed), {}
        yield from counted(words, counts)

    read = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    return read.mapInArrow(work, "lang string, word string, code bigint, n bigint, codes array<bigint>")


def encoded(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """lang, word, code, n of every word, and lang, codes of all texts, with a seed that gives all words different codes."""
    for seed in range(_SEEDS):
        both = settle(encode(docs, text, lang, seed), "codes")
        words = settle(both.where(F.col("word").isNotNull()).groupBy("lang", "word", "code").agg(F.sum("n").alias("n")), "words")
        if not words.groupBy("code").agg(F.min("word").alias("a"), F.max("word").alias("b")).where("a <> b").limit(1).count():
            return words, both.where(F.col("codes").isNotNull()).select("lang", "codes")
    raise ValueError("words with equal codes under every seed")


def _positions(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """For each language and step: the codes of rows on end, and the positions that a phrase may start from."""
    codes, langs = batch.column("codes"), np.array(batch.column("lang").to_pylist(), object)
    offsets = codes.offsets.to_numpy().astype(np.int64)
    values = codes.values.to_numpy(zero_copy_only=False)
    for lang in dict.fromkeys(langs.tolist()):
        rows = np.flatnonzero(langs == lang)
        part = np.cumsum(offsets[rows + 1] - offsets[rows]) // _STEP
        for some in np.split(rows, np.flatnonzero(np.diff(part)) + 1):
            sizes = offsets[some + 1] - offsets[some]
            begin = np.concatenate([[0], np.cumsum(sizes)])
            flat = values[np.arange(begin[-1]) + np.repeat(offsets[some] - begin[:-1], sizes)]
            starts = np.arange(begin[-1])
            inside = starts + LONGEST - 1 < np.repeat(begin[1:], sizes)
            yield lang, flat, starts[inside & (flat != 0)]


def _hashes(lang: str, flat: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """length, positions, hashes of all phrases within pieces."""
    codes = flat.view(np.uint64)
    h = mix(codes[at] ^ np.uint64(xxhash.xxh64_intdigest(lang.encode())))
    for length in range(2, LONGEST + 1):
        inside = flat[at + length - 1] != 0
        at, h = at[inside], h[inside]
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + codes[at + length - 1])
        yield length, at, h


def heavy_cells(codes: DataFrame, bits: int, least: int = LEAST) -> DataFrame:
    """The cells (of ``2 ** bits``) whose count of phrases reaches ``least``."""
    width = min(_SEGMENT_BITS, bits)
    ship_package(codes.sparkSession)

    def sketched(held: list[np.ndarray]) -> pa.RecordBatch:
        cells, n = np.unique(np.concatenate(held), return_counts=True)
        cells, n = cells.astype(np.int64), np.minimum(n, 255).astype(np.uint8)
        segments = np.unique(cells >> width)
        cuts = np.searchsorted(cells, segments << width).tolist() + [len(cells)]
        gaps = [pack_gaps(cells[a:b] - (s << width)) for s, a, b in zip(segments.tolist(), cuts[:-1], cuts[1:], strict=True)]
        counts = [n[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(segments, pa.int64()), pa.array(gaps, pa.binary()), pa.array(counts, pa.binary())], ["segment", "gaps", "n"])

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for lang, flat, at in _positions(batch):
                for _, _, h in _hashes(lang, flat, at):
                    held.append(h >> np.uint64(64 - bits))
                    n += len(h)
                if n >= _FLUSH_HASHES:
                    yield sketched(held)
                    held, n = [], 0
        if n:
            yield sketched(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, counts = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array((at << width) + np.flatnonzero(counts >= least))], ["cell"])

        for batch in batches:
            for segment, gaps, n in zip(*[batch.column(c).to_pylist() for c in ("segment", "gaps", "n")], strict=True):
                if segment != at:
                    if at is not None:
                        yield done()
                    at, counts = segment, np.zeros(1 << width, np.int64)
                counts[unpack_gaps(gaps)] += np.frombuffer(n, np.uint8)
        if at is not None:
            yield done()

    sketches = codes.mapInArrow(touched, "segment bigint, gaps binary, n binary").repartition("segment").sortWithinPartitions("segment")
    return sketches.mapInArrow(merge, "cell bigint")


def _beginnings(lang: str, flat: np.ndarray, at: np.ndarray, heavy: sketch.Repeats, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and words (0 after the last) of what may begin a frequent phrase at the positions ``at``, where anything does."""
    codes = flat.view(np.uint64)
    h = mix(codes ^ np.uint64(xxhash.xxh64_intdigest(lang.encode())))
    longest, hashes = np.zeros(len(flat), np.int8), np.zeros(len(flat), np.uint64)
    place = np.flatnonzero(flat[:-1])
    place = place[flat[place + 1] != 0]
    for length in range(2, LONGEST + 1):
        h = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[length - 1:])
        # Of a longer phrase both parts of one word less must be such phrases.
        place = place[heavy.test(mix(h[place] >> np.uint64(64 - bits)))]
        longest[place], hashes[place] = length, h[place]
        place = place[:-1][np.diff(place) == 1]
    at = at[longest[at] > 0]
    words = flat[at[:, None] + np.arange(LONGEST)]
    words[np.arange(LONGEST) >= longest[at, None]] = 0
    return hashes[at], words


def _pairs(lang: str, words: np.ndarray) -> np.ndarray:
    """The hashes of the first two words of rows, as ``_hashes`` has them."""
    codes = words.view(np.uint64)
    return mix(mix(codes[:, 0] ^ np.uint64(xxhash.xxh64_intdigest(lang.encode()))) * np.uint64(0x9E3779B97F4A7C15) + codes[:, 1])


def _merged(hashes: np.ndarray, words: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal rows of words, mostly side by side when sorted by hash, as one."""
    order = np.argsort(hashes, kind="stable")
    words = words[order]
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    return hashes[order][first], words[first], np.add.reduceat(n[order], first) if len(first) else n


def occurrences(codes: DataFrame, heavy: DataFrame, bits: int, heavy_at_once: int = HEAVY_CELLS) -> DataFrame:
    """lang, c1, ..., n: how many text positions these words (0 after the last) follow, as far as they may begin a frequent phrase; written."""
    shared = sketch.members(heavy, "cell", sketch.bits_for(min(heavy.count(), heavy_at_once)))

    def packed(lang: str, held: tuple) -> pa.RecordBatch:
        """Rows by segments of the hash of their first two words, as bytes; neighbours begin alike."""
        _, words, n = held
        pair = _pairs(lang, words)
        order = np.argsort(pair)
        segment = (pair[order] >> np.uint64(64 - _PAIR_BITS)).astype(np.int32)
        segments, first = np.unique(segment, return_index=True)
        parts, numbers = np.split(words[order], first[1:]), np.split(n[order], first[1:])
        return pa.RecordBatch.from_arrays([pa.array([lang], pa.string()).take(pa.array(np.zeros(len(segments), np.int32))), pa.array(segments, pa.int32()),
                                           pa.array([part.T.tobytes() for part in parts], pa.binary()), pa.array([part.tobytes() for part in numbers], pa.binary())],
                                          ["lang", "segment", "words", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple]] = {}
        for batch in batches:
            for lang, flat, at in _positions(batch):
                hashes, words = _beginnings(lang, flat, at, shared.value, bits)
                if not len(hashes):
                    continue
                own = held.setdefault(lang, [])
                own.append(_merged(hashes, words, np.ones(len(hashes), np.int64)))
                if sum(len(n) for _, _, n in own) >= _FLUSH_ROWS:
                    own[:] = [_merged(*map(np.concatenate, zip(*own, strict=True)))]
                    if len(own[0][2]) >= _FLUSH_ROWS // 2:
                        yield packed(lang, own.pop())
        for lang, own in held.items():
            if own:
                yield packed(lang, _merged(*map(np.concatenate, zip(*own, strict=True))))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def done() -> pa.RecordBatch:
            words, n = (np.concatenate(part) for part in zip(*held, strict=True))
            codes, h = words.view(np.uint64), np.zeros(len(n), np.uint64)
            for i in range(LONGEST):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + codes[:, i])
            _, words, n = _merged(h, words, n)
            return pa.RecordBatch.from_arrays([pa.array([at[1]] * len(n), pa.string()), *[pa.array(np.ascontiguousarray(c)) for c in words.T], pa.array(n)], ["lang", *_CODES, "n"])

        for batch in batches:
            for segment, lang, words, n in zip(*[batch.column(c).to_pylist() for c in ("segment", "lang", "words", "n")], strict=True):
                if (segment, lang) != at:
                    if at is not None:
                        yield done()
                    at, held = (segment, lang), []
                held.append((np.frombuffer(words, np.int64).reshape(LONGEST, -1).T, np.frombuffer(n, np.int64)))
        if at is not None:
            yield done()

    ship_package(codes.sparkSession)
    parts = codes.mapInArrow(work, "lang string, segment int, words binary, n binary").repartition("segment").sortWithinPartitions("segment", "lang")
    return settle(parts.mapInArrow(merge, "lang string, " + ", ".join(f"{c} bigint" for c in _CODES) + ", n bigint"), "occurrences")


def candidates(found: DataFrame) -> DataFrame:
    """lang, size, c1, ...: all phrases that may be frequent, from a written table of occurrences; written, and none that is frequent is missing."""
    longest = F.lit(2)
    for name in _CODES[2:]:
        longest += (F.col(name) != 0).cast("int")
    begun = found.select("lang", *_CODES, F.explode(F.sequence(F.lit(2), longest)).alias("size"))
    cut = [F.when(F.col("size") > i, F.col(c)).otherwise(F.lit(0).cast("bigint")).alias(c) for i, c in enumerate(_CODES)]
    phrases = settle(begun.select("lang", "size", *cut).distinct(), "phrases")
    kept = phrases.where("size = 2")
    made = kept
    for size in range(3, LONGEST + 1):
        longer, shorter = phrases.where(F.col("size") == size), _CODES[:size - 1]
        for own in (shorter, _CODES[1:size]):
            # The part of the phrase under the names of the shorter phrases' columns.
            part = kept.select(F.col("lang").alias("_lang"), *[F.col(a).alias(f"_{b}") for a, b in zip(shorter, own, strict=True)])
            same = F.col("lang") == F.col("_lang")
            for name in own:
                same &= F.col(name) == F.col(f"_{name}")
            longer = longer.join(part, same, "left_semi")
        kept = settle(longer, f"candidates-{size}")
        made = made.unionByName(kept)
    return settle(made, "candidates")


class Trie:
    """Phrases of word codes per language in two arrays: state s goes by symbol w to base[s] + w, if check says that it came from s."""

    def __init__(self, langs: list[str], phrases: np.ndarray) -> None:
        """``phrases`` has a row of codes for each entry of ``langs``, 0 after the last word; each may occur once."""
        self.phrases, self.langs = phrases, langs
        codes, n = np.unique(phrases[phrases != 0], return_counts=True)
        self.codes, self.symbol = codes, np.zeros(len(codes), np.int64)
        # Frequent words get small symbols, so that the children of large nodes lie close together.
        self.symbol[np.argsort(-n, kind="stable")] = np.arange(1, len(codes) + 1)
        names = sorted(set(langs))
        self.lang = {name: i + 1 for i, name in enumerate(names)}
        rows = np.concatenate([np.array([[self.lang[x]] for x in langs], np.int64).reshape(-1, 1),
                               np.where(phrases != 0, self.symbols(phrases), 0)], axis=1)
        self._build(rows)

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """The symbols of codes, 0 for those in no phrase."""
        if not len(self.codes):
            return np.zeros(codes.shape, np.int64)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.symbol[at], 0)

    def _build(self, rows: np.ndarray) -> None:
        order = np.lexsort(rows.T[::-1])
        rows = rows[order]
        self.base, self.check, self.accept = (np.full(1024, -1, np.int64) for _ in range(3))
        self.used = np.zeros(1024, bool)
        self.used[0] = True
        self.end, self.random = 1, np.random.default_rng(1)
        state = np.zeros(len(rows), np.int64)  # of each row at the present depth
        for depth in range(rows.shape[1]):
            alive = np.flatnonzero(rows[:, depth] != 0)
            if not len(alive):
                break
            parent, symbol = state[alive], rows[alive, depth]
            fresh = np.ones(len(alive), bool)
            fresh[1:] = (parent[1:] != parent[:-1]) | (symbol[1:] != symbol[:-1])
            edge = np.cumsum(fresh) - 1
            parents, symbols = parent[fresh], symbol[fresh]
            state = np.zeros(len(rows), np.int64)
            state[alive] = self._place(parents, symbols)[edge]
            ends = alive[rows[alive, depth + 1] == 0] if depth + 1 < rows.shape[1] else alive
            self.accept[state[ends]] = order[ends]
        del self.used, self.random
        self.base, self.check, self.accept = (a[:self.end + 1].copy() for a in (self.base, self.check, self.accept))

    def _place(self, parents: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Give the children of every parent (rows sorted by parent, then symbol) their states."""
        cuts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        sizes, placed = np.diff(np.append(cuts, len(parents))), np.zeros(len(parents), np.int64)
        for i in np.argsort(-sizes, kind="stable").tolist():
            if sizes[i] == 1:
                break
            own = slice(cuts[i], cuts[i] + sizes[i])
            base = self._fit(symbols[own])
            placed[own] = base + symbols[own]
            self.used[placed[own]] = True
            self.base[parents[cuts[i]]] = base
        single = cuts[sizes == 1]
        self._grow(self.end + len(single) + 1)
        placed[single] = np.flatnonzero(~self.used)[:len(single)]
        self.used[placed[single]] = True
        self.end = max(self.end, int(placed.max()))
        self.base[parents[single]] = placed[single] - symbols[single]
        self.check[placed] = parents
        return placed

    def _fit(self, symbols: np.ndarray) -> int:
        """A base whose children all find free places: the first that does of some tried at random, or else the end."""
        span = int(symbols[-1] - symbols[0]) + 1
        tried = np.sort(self.random.integers(1, self.end + 1, max(8, min(512, 200_000 // len(symbols)))))
        self._grow(self.end + span + 1)
        fits = ~self.used[tried]
        for at in symbols[1:] - symbols[0]:
            tried = tried[fits]
            fits = ~self.used[tried + at]
        first = int(tried[np.argmax(fits)]) if fits.any() else self.end + 1
        self.end = max(self.end, first + span)
        return first - int(symbols[0])

    def _grow(self, size: int) -> None:
        if size > len(self.used):
            more = max(size, 2 * len(self.used)) - len(self.used)
            self.used = np.concatenate([self.used, np.zeros(more, bool)])
            self.base, self.check, self.accept = (np.concatenate([a, np.full(more, -1, np.int64)]) for a in (self.base, self.check, self.accept))

    def advanced(self, lang: str, flat: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Which of the positions ``at`` a phrase was found from, and the phrase, in order of length; all positions go on together."""
        if lang not in self.lang:
            return
        which, state = np.arange(len(at)), np.full(len(at), self.base[0] + self.lang[lang])
        symbols = self.symbols(flat)
        for depth in range(self.phrases.shape[1]):
            symbol = symbols[at + depth]
            to = self.base[state] + symbol
            known = (symbol != 0) & (to >= 0) & (to < len(self.check))
            known[known] = self.check[to[known]] == state[known]
            at, which, state = at[known], which[known], to[known]
            found = self.accept[state]
            yield which[found >= 0], found[found >= 0]

    def accepted(self, lang: str, flat: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
        """The phrases found from the positions ``at``, in order of length."""
        for _, found in self.advanced(lang, flat, at):
            yield found


def count(found: DataFrame, phrases: DataFrame, at_once: int = TRIE_PHRASES) -> DataFrame:
    """lang, c1, ..., n: the occurrences of each phrase of a written table, overlaps included; written."""
    shards = max(_SHARDS, -(-phrases.count() // at_once))
    names = ["lang", *_CODES, "n"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, trie, counts = None, [], None, np.zeros(0, np.int64)

        def rows(part: pa.RecordBatch | pa.Table) -> np.ndarray:
            return np.stack([part.column(c).to_numpy() for c in _CODES], axis=1)

        def done() -> Iterator[pa.RecordBatch]:
            seen = np.flatnonzero(counts)
            if len(seen):
                yield pa.RecordBatch.from_arrays([pa.array([trie.langs[i] for i in seen.tolist()], pa.string()),
                                                  *[pa.array(np.ascontiguousarray(c)) for c in trie.phrases[seen].T], pa.array(counts[seen])], names)

        for batch in batches:
            shard = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                if begin == end:
                    continue
                if shard[begin] != at:
                    yield from done()
                    at, waiting, trie, counts = shard[begin], [], None, np.zeros(0, np.int64)
                part = batch.slice(begin, end - begin)
                # Phrases have no number and come first.
                n = part.column("n").to_numpy()
                own = int(np.searchsorted(n, 1))
                if own:
                    waiting.append(part.slice(0, own))
                if own == len(n):
                    continue
                if trie is None:
                    table = pa.Table.from_batches(waiting) if waiting else None
                    trie = Trie(table["lang"].to_pylist(), rows(table)) if table else Trie([], np.zeros((0, LONGEST), np.int64))
                    waiting, counts = [], np.zeros(len(trie.langs), np.int64)
                part, n = part.slice(own), n[own:]
                lang = part.column("lang").dictionary_encode()
                of, flat = lang.indices.to_numpy(), rows(part).ravel()
                for i, name in enumerate(lang.dictionary.to_pylist()):
                    some = np.flatnonzero(of == i)
                    for which, accepted in trie.advanced(name, flat, some * LONGEST):
                        # Sums below 2 ** 53, which floating point holds exactly.
                        counts += np.bincount(accepted, weights=n[some[which]], minlength=len(counts)).astype(np.int64)
        yield from done()

    both = phrases.select("lang", *_CODES, F.lit(0).cast("bigint").alias("n")).unionByName(found.select(*names))
    both = both.withColumn("shard", F.pmod(F.xxhash64("lang", "c1", "c2"), F.lit(shards)).cast("int"))
    ship_package(found.sparkSession)
    counts = both.repartition("shard").sortWithinPartitions("shard", "n").mapInArrow(work, "lang string, " + ", ".join(f"{c} bigint" for c in _CODES) + ", n bigint")
    return settle(counts, "counts")


def _score(a: Column, parts: Column) -> Column:
    """floor(2000000 * a / parts) without rounding: numbers of 38 digits."""
    return F.call_function("div", a.cast("decimal(20,0)") * F.lit(2_000_000).cast("decimal(8,0)"), parts)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, **sizes: int) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases.

    A NULL language is ``und``, a NULL text empty. Texts of any length are read whole; phrases never cross
    documents; repeated rows count again; ties are ordered by count, then phrase, so ranks are
    unique. An empty input, or one without a phrase as frequent as asked, gives no rows. Other columns are not read.
    """
    with shuffles_dropped(docs.sparkSession):
        words, codes = encoded(docs, text, lang)
        totals = settle(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
        total = totals.agg(F.sum("n")).first()[0] or 0
        bits = max(16, int(max(total // 2, 1) - 1).bit_length())
        heavy = settle(heavy_cells(codes, bits, least), "heavy")
        found = occurrences(codes, heavy, bits, sizes.get("heavy_at_once", HEAVY_CELLS))
        counts = count(found, candidates(found), sizes.get("at_once", TRIE_PHRASES)).where(F.col("n") >= least)
        phrases = settle(counts.select("lang", F.array_remove(F.array(*_CODES), 0).alias("phrase"), F.col("n").alias("a")), "phrases")
        frequent = words.where(F.col("n") >= least).select("lang", F.array("code").alias("part"), F.col("n").alias("f"))
        parts = settle(frequent.unionByName(phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))), "parts")
    size = F.size("phrase")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.withColumns({"first": F.slice("phrase", F.lit(1), F.col("k")), "rest": F.slice("phrase", F.col("k") + 1, size - F.col("k"))})
    for side, name in (("first", "l"), ("rest", "r")):
        known = parts.select(F.col("lang").alias("_lang"), F.col("part").alias("_part"), F.col("f").alias(name))
        cuts = cuts.join(known, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part"))).drop("_lang", "_part")
    score = _score(F.col("a"), F.col("l").cast("decimal(20,0)") + F.col("r").cast("decimal(20,0)"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    # What every longer phrase holds, with the largest count of such a phrase.
    inner = F.expr("flatten(transform(sequence(2, size(phrase) - 1), m -> transform(sequence(1, size(phrase) - m + 1), i -> slice(phrase, i, m))))")
    held = phrases.where(size > 2).select("lang", F.explode(inner).alias("part"), "a").groupBy("lang", "part").agg(F.max("a").alias("longer"))
    held = held.select(F.col("lang").alias("_lang"), F.col("part").alias("_part"), F.col("longer").cast("decimal(20,0)").alias("_longer"))
    absorbed = (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_part")) & (F.col("_longer") * 100 >= F.col("a").cast("decimal(20,0)") * ABSORBED)
    kept = scored.join(held, absorbed, "left_anti")
    named = kept.select("*", F.posexplode("phrase").alias("at", "code")).join(words.select("lang", "code", "word"), ["lang", "code"])
    spelled = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ")
    named = named.groupBy("lang", "phrase", "a", "cut").agg(spelled.alias("spelled"))
    order = [F.col("cut.score").desc(), F.col("a").desc(), F.col("spelled")]
    # The best of each part of a language first, so that no task takes all phrases of one.
    near = F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("spelled"), F.lit(_PARTS))).orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    best = named.withColumn("near", near).where(F.col("near") <= top).withColumn("rank", rank).where(F.col("rank") <= top).join(totals, "lang")
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), F.col("spelled").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")


def op13_phrases(docs: DataFrame) -> DataFrame:
    return collocations(docs)
