import random

import pytest

SCHEMA = ("doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, id STRING, row STRING, fp INT, digest INT, kept STRING, "
          "tokens STRING, removed INT, hash STRING, root INT, slot STRING, score STRING, length STRING, _key INT, vector INT")


def make_texts():
    """Empty, blank, short, very long and repeated texts, copies and near copies, shared passages, several scripts."""
    rng = random.Random(5)
    syllables = ["ka", "lo", "mir", "ten", "sha", "vu", "él", "ñor", "ber", "ung"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, base = prose(60), prose(200)
    texts = [None, "", "   \t\n", "a", "A", "a b", "a b c d", "One line only.", base, base.upper(), base.replace("ka", "KA", 1), base + " end"]
    texts += [prose(rng.randint(5, 120)) + " " + passage + "\n" + prose(rng.randint(0, 80)) for _ in range(12)]
    texts += [passage, passage[:120], "a " * 300, "x" * 500, "日本語 の テキスト " * 30, prose(9000), "café́ ÀÉ naïve ΑΣ ΟΔΟΣ 'S it'LL <|endoftext|>  x　y 12345 \U0001f600"]
    words = base.split()
    for _ in range(6):
        near = list(words)
        near[rng.randrange(len(near))] = word()
        texts.append(" ".join(near))
    return texts


@pytest.fixture(scope="session")
def texts():
    return make_texts()


@pytest.fixture(scope="session")
def stored(spark, tmp_path_factory):
    """Write rows (doc_id, text) with further columns of clashing names, in several files, and read them."""

    def store(rows):
        folder = str(tmp_path_factory.mktemp("docs")) + "/documents.parquet"
        wide = [(k, t, ["en", "de", None][i % 3], f"src{i % 4 if i % 2 else 0}", len(t or ""), "x", "r", 1, 2, "no", "t", 3, "h", 4, "s", "z", "l", 5, 6) for i, (k, t) in enumerate(rows)]
        spark.createDataFrame(wide, SCHEMA).repartition(3).write.parquet(folder)
        return spark.read.parquet(folder)

    return store


@pytest.fixture(scope="session")
def docs(stored, texts):
    """One row per text, and one more with a NULL key."""
    return stored([*((3 * i, t) for i, t in enumerate(texts)), (None, texts[8])])


@pytest.fixture(scope="session")
def doc_rows(texts):
    return [*((3 * i, t) for i, t in enumerate(texts)), (None, texts[8])]


@pytest.fixture(scope="session")
def repeated(stored, texts):
    """Whole rows twice."""
    return stored([(i, t) for i, t in enumerate(texts)] * 2)


@pytest.fixture(scope="session")
def empty(stored):
    return stored([])
