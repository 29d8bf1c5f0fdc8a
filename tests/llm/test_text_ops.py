"""Language identification, repair of conversations and collocations."""

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import cache
from math import log

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreline.llm import language, phrases, sketch, turns
from scoreline.llm.rolling import mix

from . import brute


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- language


WORDS = {"en": "the of and with house water garden morning", "de": "der und mit haus wasser garten morgen schön", "fr": "le et avec maison eau jardin matin été"}


def language_rows(n=400):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang].split()).title() for _ in range(rng.randint(1, 12))) + " 42!", lang))
    return rows


@pytest.fixture(scope="module")
def spoken(frame_of):
    return frame_of(language_rows(), "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def frame_of(spark, tmp_path_factory):
    def store(rows, schema, files=3):
        folder = str(tmp_path_factory.mktemp("rows"))
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(folder + "/t")
        return spark.read.parquet(folder + "/t")

    return store


def plain_language(rows):
    """Counts, tables and scores in plain Python."""
    learned = [(t, lang) for k, t, lang in rows if lang is not None and (k is None or zlib.crc32(str(k).encode()) % 4 != 2)]
    names = sorted({lang for _, lang in learned})
    counts = {lang: Counter(w for t, own in learned if own == lang for w in language.words_of(t)) for lang in names}
    runs = {lang: Counter(f"\x02{w}\x03"[i:i + n] for w in counts[lang] for i in range(len(w) + 1) for n in range(1, 5) if i + n <= len(w) + 2) for lang in names}
    known = set().union(*counts.values()) if names else set()
    seen = [{r for c in runs.values() for r in c if len(r) == n} for n in range(5)]

    def freq(count, entries, x):
        return log((count[x] + 0.5) / sum(count[e] + 0.5 for e in entries))

    freq_word = cache(lambda lang, w: freq(counts[lang], known, w))
    freq_run = cache(lambda lang, r: freq(runs[lang], seen[len(r)], r))

    def predict(text):
        words = language.words_of(text)
        if not words or not names:
            return "und", 0.0
        scores = {}
        for lang in names:
            total = log(sum(own == lang for _, own in learned) / len(learned))
            for w in words:
                if w in known:
                    total += freq_word(lang, w)
                    continue
                edged = f"\x02{w}\x03"
                for i in range(len(edged) - 1):
                    run = next((edged[i:i + n] for n in (4, 3, 2, 1) if i + n <= len(edged) and edged[i:i + n] in seen[n]), None)
                    total += freq_run(lang, run) / len(run) if run else 0
            scores[lang] = total
        best = min(names, key=lambda lang: (-scores[lang], lang))
        return best, 1 / sum(np.exp(s - scores[best]) for s in scores.values())

    return predict


def test_language_against_plain_version(spoken):
    rows = language_rows()
    odd = [(1000, None, "en"), (1001, "", None), (1002, "12 % 34", "en"), (1003, "Häuser gärten", None), (1004, "x" * 50_000, None), (None, "jardinage", "fr"), (1005, "日本語", None)]
    predict = plain_language(rows)
    model = language.train(spoken)
    reader = language.Reader(model)
    for _, text, _ in rows[:150] + odd:
        lang, score = predict(text)
        found = reader.score(text)
        assert found[0] == lang and found[1] == pytest.approx(score, abs=1e-6)


def test_language_rows_and_odd_texts(frame_of):
    rows = language_rows()
    odd = [(1000, None, "en"), (1001, "", None), (1002, "12 % 34", "en"), (1003, "der und", None), (None, "le matin", None), (7, "the of", "en")]
    found = language.op11_language(frame_of(rows + odd, "doc_id long, text string, lang string")).collect()
    assert len(found) == len(rows) + len(odd)
    by = {r["doc_id"]: r for r in found}
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert [(by[k]["lang_pred"], by[k]["score"]) for k in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert by[1003]["lang_pred"] == "de" and by[None]["lang_pred"] == "fr"
    held = [(r["lang_pred"], dict((k, lang) for k, _, lang in rows)[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] < 400]
    assert sum(a == b for a, b in held) / len(held) > 0.97


def test_language_tables_are_bounded_and_unseen_words_scored(spoken):
    model = language.train(spoken, most_words=5, most_runs=20)
    assert len(model.word_row) == 5 and len(model.run_row) <= 4 * 20
    reader = language.Reader(model)
    right = [reader.score(t)[0] == lang for _, t, lang in language_rows()]
    assert sum(right) / len(right) > 0.8
    reader.room = -1
    assert reader.score("der garten") == language.Reader(model).score("der garten")


def test_language_does_not_learn_from_held_out_rows(frame_of):
    rows = [(k, "zzz", "xx") for k in range(200) if zlib.crc32(str(k).encode()) % 4 == 2] + [(k, "aaa", "yy") for k in range(200) if zlib.crc32(str(k).encode()) % 4 != 2]
    assert language.train(frame_of(rows, "doc_id long, text string, lang string")).languages == ["yy"]


def test_language_of_nothing(empty, docs, frame_of):
    assert language.op11_language(empty).count() == 0
    assert language.op11_language(docs).count() == docs.count()
    unlabelled = frame_of([(1, "some text", None)], "doc_id long, text string, lang string")
    assert tuples(language.op11_language(unlabelled), "lang_pred", "score") == [("und", 0.0)]


def test_language_limit(frame_of):
    many = frame_of([(i, "a", f"l{i}") for i in range(1000)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        language.train(many)


# --- conversations


def plain_damage(rows):
    made = {}
    for conv, turn, role, text in rows:
        made.setdefault(conv, [])
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        made[conv] += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return made


def plain_repair(rows):
    """Cheapest edits by recursion over (turn, state); letters differ wherever the next state does."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults, counts = set(), [], Counter()
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        counts[fault] += 1
    # States: 0 first, 1 user must follow, 2 assistant, 3 user or end. best[i][s] = (cost, audit, lines)
    n = len(rows)
    best = [[None] * 4 for _ in range(n + 1)]
    best[n] = [(0, "", ()), (6, "II", ("user:", "assistant:")), (3, "I", ("assistant:",)), (0, "", ())]
    for i in range(n - 1, -1, -1):
        _, role, text = rows[i]
        removed, extra = faults[i] in ("blank", "duplicate"), 3 * (faults[i] == "truncated")
        options = [[] for _ in range(4)]
        for s in range(4):
            c, a, ls = best[i + 1][s]
            options[s].append((c + 4, "D" + a, ls))
            due, to = ("a", 3) if s == 2 else ("u", 2)
            if not removed:
                c, a, ls = best[i + 1][to]
                if role[:1] == due:
                    options[s].append((c + extra, "K" + a, (f"{role}:{text}", *ls)))
                else:
                    options[s].append((c + extra + 3, "R" + a, ({"u": "user", "a": "assistant"}[due] + f":{text}", *ls)))
                if s == 0 and role[:1] == "s":
                    c, a, ls = best[i + 1][1]
                    options[s].append((c + extra, "K" + a, (f"{role}:{text}", *ls)))
        # Inserts go to another state at the same turn: twice round suffices.
        best[i] = [min(o) for o in options]
        for _ in range(4):
            for s in range(4):
                due, to = ("a", 3) if s == 2 else ("u", 2)
                c, a, ls = best[i][to]
                options[s].append((c + 3, "I" + a, ({"u": "user", "a": "assistant"}[due] + ":", *ls)))
                best[i][s] = min(options[s])
    cost, audit, lines = best[0][0]
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
TURNS = "conv_id long, turn long, role string, text string"


def random_turns(rng, n, roles=("system", "user", "assistant", "tool", "")):
    texts = ["Yes.", "No", "Why?", "", " \t", "Ends here! ", "…", "Well"]
    return [(rng.choice([None, *range(n)]) if rng.random() < 0.1 else i, rng.choice(roles), rng.choice(texts) + (f" {i}." if rng.random() < 0.6 else "")) for i in range(n)]


@pytest.mark.parametrize("block", [3, 128])
def test_alignment_against_recursion(block, monkeypatch):
    monkeypatch.setattr(turns, "BLOCK", block)
    rng = random.Random(block)
    for n in [*range(9)] * 25 + [40, 150, 300]:
        roles = rng.choice([("system", "user", "assistant", "tool", ""), ("user", "assistant"), ("system", "user"), ("assistant",)])
        rows = sorted(random_turns(rng, n, roles), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        own, seen = turns.Conversation(), set()
        for turn, role, text in rows:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            own.add(turn, role, text, fault)
        assert tuple(own.result().values()) == plain_repair(rows)


def test_conversations_against_plain_version(frame_of):
    rng = random.Random(9)
    rows = [(c, t, None if rng.random() < 0.05 else role, None if rng.random() < 0.05 else text) for c in range(300) for t, role, text in random_turns(rng, rng.randint(1, 12))]
    rows += [(None, 1, "user", "Hello."), (None, None, None, None), (999, None, "user", "A."), (999, None, "assistant", "B.")]
    rows += [(5000, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(700)] + rows[:40]
    wanted = sorted(((c, *plain_repair(r)) for c, r in plain_damage(rows).items()), key=repr)
    found = turns.op12_turns(frame_of([(*r, "x", 1) for r in rows], TURNS + ", gone string, fault int"))
    assert tuples(found, *COLUMNS) == wanted
    assert any(audit == "" for *_, audit, _ in wanted)


def test_conversations_of_nothing(frame_of):
    assert turns.op12_turns(frame_of([], TURNS)).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    found = turns.op12_turns(frame_of([(dropped, 0, "user", "Hi.")], TURNS))
    assert tuples(found, *COLUMNS) == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_registered_conversations(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    wanted = sorted(((c, *plain_repair(r)) for c, r in plain_damage(rows).items()), key=repr)
    assert tuples(turns.op12_turns(spark.read.parquet(f"{small}/conversations.parquet")), *COLUMNS) == wanted


# --- collocations


def plain_phrases(rows, least=30, top=2000):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = lang or "und"
        count = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", brute.lower(text)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            count.update(tuple(words[i:i + n]) for n in range(1, 5) for i in range(len(words) - n + 1))
    made = []
    for lang, count in counts.items():
        found = {p: n for p, n in count.items() if n >= least and len(p) > 1}
        scored = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            made.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(made, key=repr)


PHRASE_COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def phrase_rows(n=2500):
    rng = random.Random(4)
    words = ["ka", "Lo", "mir", "ten", "ÉL", "ñor", "x", "été", "A-B"]
    fixed = ["new york city hall", "ka ka ka ka", "one two"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice([rng.choice(words), rng.choice(words), rng.choice(fixed), f"rare{rng.randint(0, 500)}"]) + rng.choice([" ", " ", " ", ". ", ",", "\t", "\n", " "]) for _ in range(rng.randint(0, 25)))
        rows.append((i, text, rng.choice(["en", "en", "fr", None])))
    return [*rows, (n, None, "en"), (n + 1, "", None), (n + 2, "only once in spanish", "es"), (n + 3, "ka " * 2000 + "lo", "fr")]


def test_phrases_against_plain_version(frame_of):
    rows = phrase_rows()
    docs = frame_of([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, c1 int, code string")
    wanted = plain_phrases([(t, lang) for _, t, lang in rows])
    assert len(wanted) > 50
    assert tuples(phrases.collocations(docs), *PHRASE_COLUMNS) == wanted
    # Several tries and several parts of the heavy cells; another limit of rows.
    assert tuples(phrases.collocations(docs, top=7, at_once=20, heavy_at_once=60), *PHRASE_COLUMNS) == plain_phrases([(t, lang) for _, t, lang in rows], top=7)


def test_phrases_of_small_tables(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    assert tuples(phrases.op13_phrases(docs), *PHRASE_COLUMNS) == plain_phrases(rows)


def test_phrases_of_nothing(empty, frame_of):
    assert phrases.op13_phrases(empty).count() == 0
    assert phrases.op13_phrases(frame_of([(1, "a b c", "en")], "doc_id long, text string, lang string")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, parts = 4_611_686_018_427_387_905, 9_223_372_036_854_775_807
    found = spark.range(1).select(phrases._score(F.lit(a), F.lit(parts).cast("decimal(20,0)") + F.lit(parts).cast("decimal(20,0)")).alias("s")).first()[0]
    assert found == 2_000_000 * a // (2 * parts)


def test_trie_finds_what_a_dictionary_finds():
    rng = random.Random(8)
    entries = {(rng.choice("xy"), *[rng.randint(1, 12) for _ in range(rng.randint(2, 4))]) for _ in range(600)}
    entries = sorted(entries, key=repr)
    trie = phrases.Trie([e[0] for e in entries], np.array([[*e[1:], *[0] * (5 - len(e))] for e in entries], np.int64))
    flat = np.array([rng.randint(0, 14) for _ in range(3000)] + [0, 0, 0], np.int64)
    for lang in "xyz":
        at = np.flatnonzero(flat[:-3])
        found = Counter(entries[i] for part in trie.accepted(lang, flat, at) for i in part.tolist())
        wanted = Counter((lang, *flat[i:i + n].tolist()) for i in range(3000) for n in (2, 3, 4) if (lang, *flat[i:i + n].tolist()) in set(entries))
        assert found == wanted


def test_phrases_are_counted_in_two_passes_over_the_codes_however_many_there_are(frame_of, monkeypatch):
    passes = []
    encoded = phrases.encoded

    def watched(docs, text, lang):
        words, codes = encoded(docs, text, lang)
        kept = type(codes).mapInArrow
        monkeypatch.setattr(type(codes), "mapInArrow", lambda df, *a, **b: (passes.append(1) if df is codes else None, kept(df, *a, **b))[1])
        return words, codes

    monkeypatch.setattr(phrases, "encoded", watched)
    rows = phrase_rows(600)
    docs = frame_of(rows, "doc_id long, text string, lang string")
    assert tuples(phrases.collocations(docs, least=5, at_once=5, heavy_at_once=10), *PHRASE_COLUMNS) == plain_phrases([(t, lang) for _, t, lang in rows], least=5)
    assert len(passes) == 2


def test_beginnings_of_phrases_are_as_long_as_all_their_parts_allow():
    heavy, bits = sketch.Repeats(20), 40
    flat = np.array([1, 2, 3, 4, 5, 0, 2, 3, 9, 0, 0, 0], np.int64)
    for some in ([1, 2], [2, 3], [3, 4], [1, 2, 3], [2, 3, 4], [1, 2, 3, 4], [3, 4, 5]):
        code = np.array([*some, 0, 0, 0], np.int64)
        *_, (_, _, h) = [x for x in phrases._hashes("en", code, np.array([0])) if len(x[2])]
        heavy.add(mix(h >> np.uint64(64 - bits)))
    hashes, words = phrases._beginnings("en", flat, np.flatnonzero(flat[:-3]), heavy, bits)
    # 3 4 5 is heavy, but 4 5 is not.
    assert words.tolist() == [[1, 2, 3, 4], [2, 3, 4, 0], [3, 4, 0, 0], [2, 3, 0, 0]]
    assert len(set(hashes.tolist())) == 4


def test_codes_take_another_seed_if_words_share_one(frame_of, monkeypatch):
    calls = []
    encode = phrases.encode
    monkeypatch.setattr(phrases, "encode", lambda docs, text, lang, seed: calls.append(seed) or encode(docs, text, lang, seed).withColumn("code", F.when(F.lit(seed == 0) & F.col("code").isNotNull(), 7).otherwise(F.col("code"))))
    words, _ = phrases.encoded(frame_of([(1, "a b", "en")], "doc_id long, text string, lang string"))
    assert calls == [0, 1] and words.count() == 2
