"""Toxicity, mixing, sharding, vectors, packing and secrets."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scoreline.llm import mixing, packing, secrets, sharding, toxicity, vectors

from . import brute

VOCABULARY = public_tokenizers.path(packing.VOCABULARY)


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- mixing


def test_rake_meets_the_marginals():
    rng = np.random.default_rng(3)
    codes = [rng.integers(0, n, 200) for n in (5, 4, 3)]
    for code, n in zip(codes, (5, 4, 3)):
        code[:n] = range(n)
    targets = [np.arange(1, n + 1) / (n * (n + 1) / 2) for n in (5, 4, 3)]
    weights, gap = mixing.rake(rng.random(200) + 0.1, codes, targets)
    assert gap < 1e-9 and weights.sum() == pytest.approx(1)
    for code, target in zip(codes, targets):
        assert np.bincount(code, weights) == pytest.approx(target)


def test_probabilities_spend_the_budget():
    tokens, weights = np.array([10.0, 1000.0, 500.0]), np.array([0.6, 0.3, 0.1])
    p = mixing.capped_probabilities(tokens, weights, 400)
    assert p[0] == 1 and (p * tokens).sum() == pytest.approx(400) and p[1] * tokens[1] == pytest.approx(3 * p[2] * tokens[2])
    assert mixing.capped_probabilities(tokens, weights, 9999).tolist() == [1, 1, 1]


def test_mix_against_plain_version(docs, doc_rows):
    found = mixing.op2_mixing(docs).toPandas()
    assert len(found) == len(doc_rows)
    cells = found.groupby(["source", "lang", "topic"], as_index=False)["tokens"].sum()
    wanted = mixing.calibrate(cells, mixing.TEMPERATURES, mixing.BUDGET)
    joined = found.merge(wanted, on=["source", "lang", "topic"], suffixes=("", "_wanted"))
    assert np.allclose(joined["probability"], joined["probability_wanted"])
    texts = {k: t or "" for k, t in doc_rows}
    assert all(n == max(len(re.findall(r"[^\x20\x09-\x0D]+", texts[None if pd.isna(k) else int(k)])), 1) for k, n in zip(found["doc_id"], found["tokens"]))


def test_runs_of_blanks_part_words_once(spark):
    texts = [" " * 1000, "a  b", "a b\n\n\n", "", "\u00a0", " a\tb\x0bc\x0cd\re "]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").orderBy("i").select(mixing.tokens_of(F.col("text")).alias("n")).collect()
    assert [r["n"] for r in found] == [1, 2, 2, 1, 1, 5]


def test_targets_that_contradict_each_other_are_told():
    cells = pd.DataFrame({"source": ["a", "b"], "lang": ["x", "y"], "topic": ["t", "t"], "tokens": [10, 10]})
    with pytest.warns(UserWarning, match="contradict"):
        mixing.calibrate(cells, {"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.1, "y": 0.9}}, 0.5)


def test_mix_draws_by_probability(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("some words here").alias("text"), F.lit("en").alias("lang"),
                                      F.when(F.col("id") % 3 < 2, "big").otherwise("small").alias("source"))
    found = mixing.mix(docs, {"source": {"big": 0.5, "small": 0.5}, "lang": {"en": 1.0}, "topic": {"prose": 1.0}}, 0.4)
    drawn = {r["source"]: r["n"] for r in found.where("selected").groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert drawn["big"] == pytest.approx(4000, rel=0.06) and drawn["small"] == pytest.approx(4000, rel=0.06)


def test_mix_refuses_too_many_cells(docs):
    with pytest.raises(ValueError, match="cells"):
        mixing.mix(docs, most_cells=2)


# --- sharding


def plain_table(shards, slots):
    """Claims slot by slot, with whole preference lists."""
    order = {}
    for name in shards:
        offset = int.from_bytes(hashlib.sha256(f"offset:{name}".encode()).digest()[:8], "big") % slots
        skip = int.from_bytes(hashlib.sha256(f"skip:{name}".encode()).digest()[:8], "big") % (slots - 1) + 1
        order[name] = [(offset + i * skip) % slots for i in range(slots)]
    owner = {}
    while len(owner) < slots:
        for name in sorted(shards):
            for _ in range(shards[name]):
                free = [s for s in order[name] if s not in owner]
                if free:
                    owner[free[0]] = name
    return [owner[s] for s in range(slots)]


def test_lookup_table():
    shards = {"b": 1, "a": 2, "c": 1}
    assert [sorted(shards)[o] for o in sharding.lookup_table(shards, 101)] == plain_table(shards, 101)
    whole = sharding.lookup_table(sharding.SHARDS)
    names, weight = sorted(sharding.SHARDS), sum(sharding.SHARDS.values())
    for shard, n in Counter(whole.tolist()).items():
        assert abs(n - sharding.SLOTS * sharding.SHARDS[names[shard]] / weight) <= 2


def test_few_slots_move():
    before = sharding.lookup_table({f"s{i}": 1 for i in range(20)}, 10_007)
    after = sharding.lookup_table({f"s{i}": 1 for i in range(20) if i != 7}, 10_007)
    names, left = sorted(f"s{i}" for i in range(20)), sorted(f"s{i}" for i in range(20) if i != 7)
    moved = sum(names[a] != left[b] for a, b in zip(before, after)) / 10_007
    assert moved < 0.12
    for bad in ({}, {"a": 0}):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 11)
    with pytest.raises(ValueError):
        sharding.lookup_table({"a": 1}, 12)


def test_placement(docs, doc_rows, empty, spark, tmp_path):
    found = sharding.op6_shard_lookup(docs).collect()
    table, names = sharding.lookup_table(sharding.SHARDS), sorted(sharding.SHARDS)
    assert len(found) == len(doc_rows) and all(r["shard"] == names[table[r["slot"]]] for r in found)
    assert sharding.op6_shard_lookup(empty).count() == 0
    sharding.write_shards(docs, {"a": 1, "b": 1}, str(tmp_path / "shards"), files=2)
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(doc_rows)


# --- packing


def test_packing_keeps_every_token(docs, doc_rows):
    tokenizer, found = Tokenizer.from_file(VOCABULARY), defaultdict(list)
    sequences = defaultdict(list)
    for r in packing.op9_packing(docs).collect():
        found[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for key, text in doc_rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        pieces = sorted(found[key], key=lambda r: r["start"])
        assert [p["start"] for p in pieces] == [0, *np.cumsum([p["length"] for p in pieces])[:-1].tolist()]
        for p in pieces:
            assert p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(ids[p["start"]:p["start"] + p["length"]].tobytes())
        assert sum(p["length"] for p in pieces) == len(ids)
    for inside in sequences.values():
        inside.sort()
        assert [o for o, _ in inside] == [0, *np.cumsum([n for _, n in inside])[:-1].tolist()] and sum(n for _, n in inside) <= packing.SEQUENCE


def plain_shortest_first(lengths, most):
    packs = []
    for length in sorted(lengths, reverse=True):
        fits = [p for p in packs if p + length <= most]
        if fits:
            packs[packs.index(min(fits))] += length
        else:
            packs.append(length)
    return sorted(packs)


def test_histogram_packing_is_shortest_first():
    rng = random.Random(8)
    for most, n in ((10, 60), (64, 300), (4096, 400)):
        lengths = [min(most, int(rng.expovariate(4 / most)) + 1) for _ in range(n)]
        patterns = packing.pack_histogram(Counter(lengths), most)
        totals = []
        for packs, items in patterns:
            total = 0
            while items:
                total += items[1] * items[2]
                items = items[0]
            totals += [total] * packs
        assert sum(totals) == sum(lengths) and max(totals) <= most
        assert sorted(totals) == plain_shortest_first(lengths, most)


def test_packing_edge_tables(empty, repeated, texts):
    assert packing.op9_packing(empty).count() == 0
    assert packing.op9_packing(repeated).where("start = 0").count() == 2 * len(texts)


# --- vectors


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 24))
    rows = [(10 * i, c.tolist()) for i, c in enumerate(centres)]
    rows += [(1000 + i, (centres[i % 9] + rng.standard_normal(24) * 0.28).tolist()) for i in range(300)]
    rows += [(2000 + i, rows[i % 5][1]) for i in range(30)] + [(2100, [2 * v for v in rows[3][1]]), (2101, [1e-200 * v for v in rows[3][1]])]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 24), (3003, [float("nan")] * 24), (3004, [None, *[1.0] * 23]), (3005, [float("inf")] * 24), (3006, [1.0, 2.0]), (3007, [2.0, 4.0])]
    vectors_df = spark.createDataFrame([(k, v, 1, "x", "y") for k, v in rows], "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT, id STRING, root STRING")
    unit = {}
    for k, v in rows:
        if v and None not in v and np.isfinite(v).all() and any(v):
            v = np.array(v) / np.abs(v).max()
            unit[k] = v / np.linalg.norm(v)
    linked = lambda a, b: a in unit and b in unit and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95
    keys = [k for k, _ in rows]
    root = brute.components(keys, linked)
    wanted = [(k, sum(linked(k, o) for o in keys if o != k), root[k], root[k] == k) for k in keys]
    found = tuples(vectors.op7_vectors(vectors_df), "vec_id", "n_links", "component_id", "kept")
    assert found == sorted(wanted, key=repr)


def test_large_buckets_are_dealt_as_blocks(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, (np.ones(16) + rng.standard_normal(16) * 0.15).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    whole = tuples(vectors.near_vectors(df), "vec_id", "n_links", "component_id")
    monkeypatch.setattr(vectors, "BLOCK", 16)
    assert tuples(vectors.near_vectors(df), "vec_id", "n_links", "component_id") == whole


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    x, y = rng.standard_normal((2, 2000, 64))
    y = 0.8 * x + 0.6 * y
    x, y = x / np.linalg.norm(x, axis=1, keepdims=True), y / np.linalg.norm(y, axis=1, keepdims=True)
    turn = vectors.rotations(64, 192)
    guess, spread = vectors.estimate(x @ turn, y @ turn, 64)
    error = guess - np.einsum("ij,ij->i", x, y)
    assert abs(error.mean()) < 0.005 and (np.abs(error) <= vectors.DEVIATIONS * spread).all()


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    assert vectors.op7_vectors(none).count() == 0
    assert tuples(vectors.op7_vectors(spark.createDataFrame([(1, None), (1, [0.0])], "vec_id BIGINT, embedding ARRAY<FLOAT>")), "vec_id", "n_links", "kept") == [(1, 0, True)] * 2


# --- secrets

KEY = "kX9vQ2mZpL7rT4wB8nJ5cY3hF6dG1sA0eUiOxVzRqWtMyNbKlPjHgDf2"


def test_secrets_against_plain_patterns(stored, docs, doc_rows):
    import re

    rows = [(i, t) for i, t in enumerate([
        "password=abcdefgh", "PassWord : 'abc", "my api_key = \"Zx81-abc.def/+=\" and APIKEY=12345678", "token: token=abcdefgh token=short", "é é secret=ññ secret=longenough",
        "AKIAABCDEFGHIJKL AKIAABCDEFGHIJK", "AKIA" * 5, "0123456789abcdef" * 2, "x" + "0a" * 40 + "G" + "f" * 31, "ſecret=abcdefgh toKen=abcdefgh", f"see {KEY} there", None, ""])]
    patterns = {"assign": re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
                "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}
    least = {"assign": lambda m: len(m[2]) >= 8, "access": lambda m: len(m[0]) >= 16, "hex": lambda m: len(m[0]) >= 32}
    for table, source in ((stored(rows), rows), (docs, doc_rows)):
        found = {r["doc_id"]: r for r in secrets.op10_secrets(table).collect()}
        assert len(found) == len(source)
        for key, text in source:
            spans = [(m.start(), i, f"{kind}:{m.start()}:{m.end()}") for i, kind in enumerate(patterns) for m in patterns[kind].finditer(text or "") if least[kind](m)]
            joined = ",".join(s for _, _, s in sorted(spans))
            assert found[key]["base_sha256"] == brute.sha(joined)
            assert [s for s in found[key]["spans"].split(",") if s and not s.startswith("random")] == [s for s in joined.split(",") if s]
            assert [found[key][f"n_{k}"] for k in patterns] == [sum(s.startswith(k) for _, _, s in spans) for k in patterns]


def test_random_tokens_are_found_among_words(stored):
    rng = random.Random(6)
    alphabets = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"]
    syllables = ["tion", "ment", "the", "er", "ing", "con", "pre", "al", "ism", "ness", "ly", "in"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(5, 9)))
    rows, planted = [], 0
    for i in range(400):
        text = " ".join(word() for _ in range(20)) + f" {word()}-2024_{word()}"
        if i % 8 == 0:
            text += " " + "".join(rng.choice(alphabets[i // 8 % 3]) for _ in range(30))
            planted += 1
        rows.append((i, text))
    found = secrets.op10_secrets(stored(rows)).collect()
    hit = [r["doc_id"] for r in found if r["n_random"]]
    # Thirty symbols are little evidence: some keys look too regular to be told from words at this rate.
    assert sum(k % 8 == 0 for k in hit) >= 0.8 * planted and sum(k % 8 != 0 for k in hit) <= 0.05 * planted


@pytest.mark.parametrize("n_words, n_names, n_keys", [(1000, 10_000, 10), (4000, 40_000, 40), (1000, 2000, 100), (100, 2000, 100)])
def test_rare_keys_are_found_at_any_size(n_words, n_names, n_keys):
    rng = random.Random(7)
    symbols = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    syllables = ["tion", "ment", "the", "er", "ing", "con", "pre", "al", "ism", "ness", "ly", "in"]
    word = lambda n: "".join(rng.choice(syllables) for _ in range(n))
    tokens = [word(22) for _ in range(n_words)] + [f"{word(10)}_{word(10)}_{rng.randrange(100)}" for _ in range(n_names)]
    tokens += ["".join(rng.choice(symbols) for _ in range(64)) for _ in range(n_keys)]
    placed = [(secrets.length_class(len(t)), secrets.step(secrets.randomness(t)), t.isalpha()) for t in tokens]
    lowest = secrets.thresholds([(*where, n) for where, n in Counter(placed).items()])
    hit = [at >= lowest.get((cls, plain), secrets.STEPS + 1) for cls, at, plain in placed]
    found = sum(hit[-n_keys:])
    assert found >= 0.9 * n_keys and sum(hit) - found <= max(1, 0.02 * found)


def test_words_do_not_pass_for_the_keys_of_their_length():
    """Most other tokens of the class are random, yet words that reach the same step are not reported with them."""
    counts = [(p, True, n) for p, n in ((1e-9, 100), (0.003, 500), (0.1, 300), (0.55, 60))] + [(p, False, n) for p, n in ((0.1, 100), (0.3, 200), (0.7, 100))]
    lowest = secrets.thresholds([(16, secrets.step(p), plain, n) for p, plain, n in counts])
    assert lowest[16, False] <= secrets.step(0.3) and lowest.get((16, True), secrets.STEPS + 1) > secrets.step(0.55)


def test_battery():
    rng = random.Random(1)
    p = [secrets.randomness("".join(rng.choice("0123456789abcdef") for _ in range(40))) for _ in range(400)]
    assert 0.3 < np.mean(p) < 0.7 and np.mean(np.array(p) < 0.05) < 0.12
    assert secrets.randomness("a" * 30) < 1e-6 and secrets.randomness("0123456789abcdef" * 4) < 1e-3
    assert secrets.encoding("00ff") == "hex" and secrets.encoding("ABZ234") == "base32" and secrets.encoding("a-B+") == "any"


# --- toxicity


@pytest.fixture(scope="module")
def costs():
    words = "idiot you are an total pathetic loser this is the worthless trash moron stupid people said clown the and of to in it was not".split()
    counts = np.ones((toxicity.LETTERS,) * 3) * 0.01
    for word in words * 5:
        codes = toxicity.letter_codes(f" {word} ")
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            counts[a, b, c] += 1
        counts[0, 0, codes[1]] += 1
    return toxicity.letter_costs(counts)


@pytest.mark.parametrize("disguised, plain", [("1d10t", "idiot"), ("p@thet1c", "pathetic"), ("l0$er", "loser"), ("m-o-r-o-n", "moron"), ("i d i o t", "idiot"),
                                              ("clooooown", "clown"), ("tr4$h", "trash"), ("s t u p i d", "stupid"), ("the", "the")])
def test_decoding(costs, disguised, plain):
    assert toxicity.decode(disguised, costs).strip() == plain


def test_words_keep_their_letters(costs):
    assert toxicity.restored_words("worthless,", costs) == ["worthles"] and toxicity.restored_words("", costs) == []


@pytest.mark.parametrize("disguised, plain", [("idi07", "idiot"), ("idio7", "idiot"), ("!diot", "idiot"), ("|diot", "idiot"), ("!d!07", "idiot"), ("7r@$#", "trash"),
                                              ("1053r", "loser"), ("(l0wn", "clown"), ("m0r0n!", "moron"), ("(m0r0n)", "moron"), ("|053r!!", "loser"), ("i/d/i/o/t", "idiot"),
                                              ("\"1d10t\"", "idiot"), ("clooooown!", "clown"), ("tra$#", "trash"), ("$tup!d,", "stupid")])
def test_signs_anywhere_in_a_token(costs, disguised, plain):
    assert plain in toxicity.restored_words(disguised, costs)


@pytest.mark.parametrize("number", ["455", "$45.50", "(2024)", "12:30,", "45%", "#12", "+49", "1,000!"])
def test_numbers_are_no_words(costs, number):
    assert toxicity.restored_words(number, costs) == []


@pytest.mark.parametrize("text", ["i d i * t", "m o r | n", "l o s € r", "( l o w n", "s t u p ¡ d", "# e l %", "² a b c"])
def test_no_spaced_word_is_passed_over(text):
    import pyarrow.compute as pc

    assert toxicity._SPACED.search(text) and pc.match_substring_regex([text], toxicity._MAY_BE_SPACED)[0].as_py()


def test_learning_and_disguise_by_signs_at_the_ends(stored, spark):
    rng = random.Random(3)
    plain = ["".join(rng.choice(["ka", "lo", "mi", "te", "sha", "vu", "ren"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    bad = ["idiot", "moron", "pathetic", "worthless"]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(40)]
        if i % 4 == 0:
            words[3:3] = rng.sample(bad, 2)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    hidden = ["idi07 and m0r0n!", "!d!07 w0r7#13$$", "|diot (p@7#37!c)", "i d i * t and m o r | n", "p a t h € t i c and i d i o 7"]
    rows += [(1000 + i, " ".join(plain[:20]) + f" {t} " + plain[3]) for i, t in enumerate(hidden)] + [(2000, " ".join(plain[:20]) + " 1 2 3 4 (2024) $45.50 455 90%! " + plain[3])]
    found = {r["doc_id"]: r["predicted"] for r in toxicity.op1_toxicity(stored(rows), spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")).collect()}
    assert [found[1000 + i] for i in range(len(hidden))] == [1] * len(hidden) and not found[2000]


def test_learning_and_disguise(stored, spark):
    rng = random.Random(2)
    plain = ["".join(rng.choice(["ka", "lo", "mi", "te", "sha", "vu", "ren"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    bad = ["idiot", "moron", "pathetic", "worthless"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = [rng.choice(plain) for _ in range(40)]
        if toxic:
            words[3:3] = rng.sample(bad, 2)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, " ".join(plain[:20]) + " you 1d10t and m0r0n " + plain[3]), (1001, " ".join(plain[:20]) + " i d i o t p a t h e t i c"), (1002, None), (1003, ""), (1004, rows[1][1]), (None, rows[1][1])]
    table = stored(rows)
    found = {r["doc_id"]: r for r in toxicity.op1_toxicity(table, spark.createDataFrame([*labels, (5000, 1, 1), (None, 1, 1), (3, 1, None)], "doc_id BIGINT, quality INT, toxic INT")).collect()}
    assert len(found) == len(rows)
    for i in range(600):
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and found[i]["predicted"] == int(i % 4 == 0) and 0 <= found[i]["score"] <= 1
    assert found[1000]["predicted"] == 1 and found[1001]["predicted"] == 1
    assert found[1002]["score"] == found[1003]["score"] and found[1004]["score"] == found[1]["score"] == found[None]["score"] and not found[None]["held_out"]


def test_no_labels(docs, doc_rows, empty, spark):
    none = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    assert toxicity.op1_toxicity(docs, none).where("predicted = 0").count() == len(doc_rows)
    assert toxicity.op1_toxicity(empty, none).count() == 0


def test_frequent_words_outlive_a_full_memory(monkeypatch):
    asked = []
    steps = [["often", *(f"rare{chr(97 + i)}{chr(97 + j)}" for j in range(20))] for i in range(6)]
    wanted = [packing.Words(VOCABULARY).ids(step) for step in steps]
    monkeypatch.setattr(packing, "REMEMBERED", 8000)
    words = packing.Words(VOCABULARY)
    model = words.model
    words.model = type("Counted", (), {"tokenize": lambda self, part: asked.append(part) or model.tokenize(part)})()
    assert [words.ids(step) for step in steps] == wanted and asked.count("often") == 1
    assert len(words.words) + len(words.words_before) < 6 * 20
