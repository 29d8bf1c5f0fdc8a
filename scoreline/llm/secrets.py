"""Secret scan: fixed patterns, and a battery of randomness tests for what they miss.

Every long token gets an encoding from its letters (digits, hexadecimal, base 32,
letters of one case with digits, base 64). Three tests ask whether its symbols could be
drawn at random from that alphabet: chi-squared uniformity, the number of runs above
and below the middle symbol, and lag-one serial correlation. Fisher's method joins
them into one p-value: high for keys, low for words and names.

How high a p-value must be depends on length, as short words pass such tests more
often. Tokens that are letters only are the null class: for each length class the
share of them above a p-value (all of that class, or with those of shorter ones, which
pass more often; carried on by a fitted tail where none is left) estimates how many
of the other tokens that are not random get there by chance, and the threshold is the
lowest one at which the expected share of false finds stays below the rate asked for.
Without any letters-only token of that length or less nothing is told random.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, settle

# Fixed values of the contract: kinds in the order of ties, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE = 8

#: Shortest token that is tested.
LEAST_TOKEN = 16
TOKEN = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST_TOKEN},}}={{0,2}}")
#: Expected share of false finds among the tokens reported by the tests.
FALSE_SHARE = 0.01
#: Letters-only tokens that their tail is fitted to: those with the highest p-values, so many at least and this share of all.
TOPMOST, TOP_SHARE = 20, 0.02
#: How far below the share of a single one of the tokens the fit is believed.
FURTHEST = 1000
#: Steps of the p-value's logarithm, down to the least joint p-value of three held to 1e-12; the last one is p = 1.
STEPS = 660
#: The lowest threshold, p = 1e-6.
LOWEST = STEPS - 120
#: A random token's p-value is below this step (p = 0.01) once in a hundred times.
FAILED = STEPS - 40

# Each finds a superset of the texts in which the pattern matches, by a linear scan.
_MAY = [r"(?i)(?:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?[A-Za-z0-9+/_.=-]{8}", r"AKIA[A-Z0-9]{12}", r"[0-9a-f]{32}",
        rf"[A-Za-z0-9+/_-]{{{LEAST_TOKEN}}}"]

_ENCODINGS = [("digits", "0123456789"), ("hex", "0123456789abcdef"), ("HEX", "0123456789ABCDEF"),
              ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), ("lower", "abcdefghijklmnopqrstuvwxyz0123456789"),
              ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
              ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
              ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
              ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
              ("any", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_")]
_SETS = [(name, frozenset(letters), letters) for name, letters in _ENCODINGS]
_CODES = {name: np.array([letters.find(chr(i)) for i in range(128)]) for name, letters in _ENCODINGS}


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and then kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_VALUE]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def encoding(token: str) -> str:
    """The smallest known alphabet that has all of the token's symbols."""
    symbols = frozenset(token)
    return next(name for name, letters, _ in _SETS if symbols <= letters)


def _upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def randomness(token: str) -> float:
    """The joint p-value of the three tests that the token is random in its encoding."""
    token = token.rstrip("=")
    name = encoding(token)
    size, n = len(next(letters for k, _, letters in _SETS if k == name)), len(token)
    codes = _CODES[name][np.frombuffer(token.encode(), np.uint8)]
    counts = np.bincount(codes, minlength=size)
    chi = float(((counts - n / size) ** 2).sum() * size / n)
    df = size - 1
    # Wilson and Hilferty: the cube root of chi-squared over its degrees is nearly normal.
    p_uniform = _upper_tail(((chi / df) ** (1 / 3) - 1 + 2 / (9 * df)) / math.sqrt(2 / (9 * df)))
    high = codes >= size / 2
    up = int(high.sum())
    down = n - up
    if up and down:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * up * down / n
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        p_runs = 2 * _upper_tail(abs(runs - mean) / spread)
    else:
        p_runs = 2.0 ** (1 - n)
    centred = codes - codes.mean()
    power = float((centred**2).sum())
    p_serial = 2 * _upper_tail(abs(float((centred[1:] * centred[:-1]).sum()) / power * math.sqrt(n))) if power else 0.0
    half = -sum(math.log(max(p, 1e-12)) for p in (p_uniform, p_runs, p_serial))
    return math.exp(-half) * (1 + half + half * half / 2)


def length_class(n: int) -> int:
    """Four classes for each doubling of the length."""
    return int(4 * math.log2(n))


def step(p: float) -> int:
    """The p-value's place on the scale of thresholds."""
    return max(0, STEPS + math.floor(20 * math.log10(max(p, 1e-300))))


def chance(words: np.ndarray) -> np.ndarray:
    """The share of plain tokens at each step or above, from their number by step; falls on where none was seen.

    Beyond the step that the topmost tokens reach the number of further steps is taken as
    geometric, with a mean two standard errors above theirs. Towards p = 1 the tail falls
    ever faster, so that this errs upwards. No share is below one in ``FURTHEST`` times the tokens.
    """
    above = words[::-1].cumsum()[::-1]
    share = (1 + above) / (1 + above[0])
    at = int(np.flatnonzero(above >= min(above[0], max(TOPMOST, TOP_SHARE * above[0])))[-1])
    if at and above[at] >= TOPMOST:
        mean = (1 + above[at + 1:].sum()) / above[at] * (1 + 2 / math.sqrt(above[at]))
        fitted = (1 + above[at]) / (1 + above[0]) * (mean / (1 + mean)) ** np.arange(STEPS + 1 - at)
        share[at:] = np.minimum(share[at:], np.maximum(fitted, 1 / (FURTHEST * (1 + above[0]))))
    return share


def thresholds(counts: list[tuple[int, int, bool, int]], rate: float = FALSE_SHARE) -> dict[tuple[int, bool], int]:
    """The lowest step to report, by (class, letters only); ``counts`` has (class, step, letters only, tokens).

    Tokens that are letters only count as false finds, so that their step is higher. A class
    without a step that keeps the rate is left out.
    """
    null, other = defaultdict(lambda: np.zeros(STEPS + 1)), defaultdict(lambda: np.zeros(STEPS + 1))
    for cls, at, natural, n in counts:
        (null if natural else other)[cls][at] += n
    chosen = {}
    for cls, have in other.items():
        reached, best = have[::-1].cumsum()[::-1], np.full(STEPS + 1, np.inf)
        words = np.zeros(STEPS + 1)
        for k in sorted((k for k in null if k <= cls), reverse=True):
            words = words + null[k]
            # Tokens that are not random, by those that fail the tests; one in a hundred random ones does, too.
            failed = words[:FAILED].sum() / words.sum()
            natural = min(have.sum(), (1 + have[:FAILED].sum()) / failed) if failed else have.sum()
            best = np.minimum(best, natural * chance(words))
        good = np.flatnonzero((reached > 0) & (best <= rate * reached) & (np.arange(STEPS + 1) >= LOWEST))
        if len(good):
            at = chosen[cls, False] = int(good[0])
            plain = null[cls][::-1].cumsum()[::-1] if cls in null else np.zeros(STEPS + 1)
            kept = np.flatnonzero(best[at] + plain[at:] <= rate * (reached[at] + plain[at:]))
            if len(kept):
                chosen[cls, True] = at + int(kept[0])
    return chosen


def _scan(batch: pa.RecordBatch, key: str, text: str) -> dict:
    column = pc.fill_null(batch.column(text), "")
    hits = np.zeros(len(column), bool)
    for pattern in _MAY:
        hits |= pc.match_substring_regex(column, pattern).to_numpy(zero_copy_only=False)
    base, tested = [[] for _ in hits], [[] for _ in hits]
    for i in np.flatnonzero(hits).tolist():
        body = column[i].as_py()
        base[i] = base_spans(body)
        for m in TOKEN.finditer(body):
            if not any(s <= m.start() and m.end() <= e for s, e, _ in base[i]):
                token = m[0]
                tested[i].append({"start": m.start(), "end": m.end(), "class": length_class(len(token)),
                                  "step": step(randomness(token)), "natural": token.isalpha()})
    return {"id": batch.column(key), "base": pa.array([[{"start": s, "end": e, "kind": k} for s, e, k in spans] for spans in base], _BASE), "tested": pa.array(tested, _TESTED)}


_BASE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
_TESTED = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("class", pa.int32()), ("step", pa.int32()), ("natural", pa.bool_())]))
_SCHEMA = "base array<struct<start:int,end:int,kind:string>>, tested array<struct<start:int,end:int,class:int,step:int,natural:boolean>>"


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


def _report(batch: pa.RecordBatch, lowest: dict[tuple[int, bool], int]) -> dict:
    out = defaultdict(list)
    for base, tested in zip(batch.column("base").to_pylist(), batch.column("tested").to_pylist(), strict=True):
        spans = [(s["start"], s["end"], s["kind"]) for s in base]
        random = [(t["start"], t["end"], "random") for t in tested if t["step"] >= lowest.get((t["class"], t["natural"]), STEPS + 1)]
        for kind in KINDS[:3]:
            out[f"n_{kind}"].append(sum(k == kind for _, _, k in spans))
        out["n_random"].append(len(random))
        out["base_sha256"].append(hashlib.sha256(_joined(spans).encode()).hexdigest())
        out["spans"].append(_joined(spans + random))
    return {"id": batch.column("id")} | {k: pa.array(v, pa.string() if isinstance(v[0], str) else pa.int64()) for k, v in out.items()}


def find_secrets(docs: DataFrame, rate: float = FALSE_SHARE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_assign, n_access, n_hex, n_random, base_sha256, spans.

    Spans are kind:start:end in code points. A token inside a span of a fixed pattern
    is not tested again. NULL and empty texts have no spans; texts of any length are
    read whole; repeated rows are reported each. An empty input gives no rows. Extra
    columns are not read. Only counts per length class and step (some ten thousand
    rows) reach the driver.
    """
    kind = dict(docs.dtypes)[key]
    found = settle(arrow_map(docs.select(key, text), lambda batch: _scan(batch, key, text), f"id {kind}, {_SCHEMA}", text), "secrets")
    counts = found.select(F.explode("tested").alias("t")).select("t.*").groupBy("class", "step", "natural").agg(F.count(F.lit(1)).alias("n")).collect()
    lowest = thresholds([(r["class"], r["step"], r["natural"], r["n"]) for r in counts], rate)
    report = arrow_map(found, lambda batch: _report(batch, lowest),
                       f"id {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, base_sha256 string, spans string", None)
    return report.withColumnRenamed("id", key)


def op10_secrets(docs: DataFrame) -> DataFrame:
    return find_secrets(docs)
