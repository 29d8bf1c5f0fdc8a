"""Exact, near and substring deduplication against plain versions."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from scoreline.llm import exact, simhash, suffix, windows
from scoreline.llm.common import shuffles_dropped, workspace
from scoreline.llm.components import connect
from scoreline.llm.rolling import mix
from scoreline.llm.sketch import bits_for, members, pack_gaps, prefixes, repeated, repeats, unpack_gaps

from . import brute


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def groups_of(rows):
    sizes, keep = Counter(), {}
    for key, text in rows:
        sizes[brute.lower(text)] += 1
        keep[brute.lower(text)] = max(keep.get(brute.lower(text), -1), -1 if key is None else key)
    return sizes, keep


def test_exact_groups(docs, doc_rows):
    sizes, keep = groups_of(doc_rows)
    wanted = [(k, keep[brute.lower(t)], sizes[brute.lower(t)], k == keep[brute.lower(t)], brute.sha(brute.lower(t))) for k, t in doc_rows]
    assert tuples(exact.op5_exact_dedup(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(wanted, key=repr)


def test_exact_keeps_one_of_repeated_rows(repeated, texts):
    kept = exact.op5_exact_dedup(repeated).where("kept").count()
    assert kept == len({brute.lower(t) for t in texts})


def test_digest_index_outlives_batches(spark, stored):
    folder = workspace(spark, "index")
    first = exact.deduplicate(stored([(1, "One"), (2, "one"), (3, "two")]), exact.DigestIndex(spark, folder, 4))
    assert tuples(first, "doc_id", "kept") == [(1, False), (2, True), (3, True)]
    spark.sql(f"DROP TABLE {exact.DigestIndex(spark, folder, 4).name}")  # as a new session: the files stay
    second = exact.deduplicate(stored([(4, "TWO"), (5, "three"), (6, None)]), exact.DigestIndex(spark, folder, 4))
    assert tuples(second, "doc_id", "kept", "known") == [(4, False, True), (5, True, False), (6, True, False)]
    assert exact.DigestIndex(spark, folder, 4).table().count() == 4


def test_digest_index_keeps_its_buckets_in_another_session(spark, stored):
    folder, rows = workspace(spark, "index"), stored([(i, f"text {i}") for i in range(500)])
    index = exact.DigestIndex(spark, folder, 8)
    assert exact.deduplicate(rows, index).where("kept").count() == 500
    index.close()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        again = exact.DigestIndex(spark, folder)
        assert again.buckets == 8 and exact.deduplicate(rows, again).where("kept").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    with pytest.raises(ValueError, match="8 buckets"):
        exact.DigestIndex(spark, folder, 4)


def test_digest_index_without_its_number_is_refused(spark):
    folder = workspace(spark, "index")
    spark.range(3).write.parquet(folder)
    with pytest.raises(ValueError, match="number of buckets"):
        exact.DigestIndex(spark, folder, 4)


def test_a_batch_that_is_run_again_keeps_its_documents(spark, stored, monkeypatch):
    index = exact.DigestIndex(spark, workspace(spark, "index"), 4)
    exact.deduplicate(stored([(1, "one"), (2, "two")]), index, batch="a")
    rows = stored([(3, "TWO"), (4, "three"), (5, "four"), (6, "Four")])
    wanted = [(3, False, True), (4, True, False), (5, False, False), (6, True, False)]
    # Died after the append, and before it: the verdicts of the batch are the same each time, and no digest lies in the index twice.
    exact.deduplicate(rows, index, batch="b")
    assert tuples(exact.deduplicate(rows, index, batch="b"), "doc_id", "kept", "known") == wanted
    with monkeypatch.context() as broken:
        broken.setattr(exact.DigestIndex, "append", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            exact.deduplicate(stored([(7, "five")]), index, batch="c")
    assert tuples(exact.deduplicate(stored([(7, "five")]), index, batch="c"), "doc_id", "kept") == [(7, True)]
    assert index.table().count() == index.table().select("digest").distinct().count() == 5
    assert tuples(exact.deduplicate(rows, index, batch="d"), "doc_id", "kept") == [(3, False), (4, False), (5, False), (6, False)]


def test_a_compacted_index_knows_the_same(spark, stored):
    index = exact.DigestIndex(spark, workspace(spark, "index"), 2)
    for i in range(3):
        exact.deduplicate(stored([(i, f"text {i}")]), index)
    made = index.compact(workspace(spark, "index"))
    assert tuples(made.table(), "digest", "keep_id", "batch") == tuples(index.table(), "digest", "keep_id", "batch")
    assert tuples(exact.deduplicate(stored([(9, "Text 1"), (10, "new")]), made), "doc_id", "kept") == [(10, True), (9, False)]


def test_digest_index_is_not_shuffled(spark, stored):
    index = exact.DigestIndex(spark, workspace(spark, "index"), 4)
    exact.deduplicate(stored([(i, str(i)) for i in range(50)]), index)
    plan = index.unseen(index.table().select("digest").distinct())._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_simhash_links(docs, doc_rows):
    rows = [r for r in doc_rows if r[0] is not None]
    prints = {k: brute.fingerprint(t) for k, t in rows}
    root = brute.components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    wanted = sorted((k, f"{prints[k]:016x}", root[k]) for k in prints)
    assert tuples(simhash.op3_simhash(docs).where("doc_id IS NOT NULL"), "doc_id", "fingerprint", "component_id") == sorted(wanted, key=repr)


@pytest.mark.parametrize("distance, segments", [(4, 3), (4, 2), (3, 4), (5, 2), (0, 1)])
def test_multi_index_finds_every_pair_once(spark, distance, segments):
    rng = random.Random(distance * 10 + segments)
    values = [rng.getrandbits(64) for _ in range(40)]
    values += [v ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for v in values for _ in range(3)]
    signed = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp BIGINT"), distance, segments).collect()
    pairs = [tuple(sorted(r)) for r in found]
    wanted = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}
    assert len(pairs) == len(set(pairs)) and set(pairs) == wanted


def test_a_dense_group_gives_few_links(spark):
    rng = random.Random(3)
    centre = rng.getrandbits(63)
    values = sorted({centre ^ sum(1 << b for b in rng.sample(range(12), rng.randint(0, 12))) for _ in range(1500)})
    distinct = spark.createDataFrame([(v,) for v in values], "fp BIGINT")
    assert len(values) > 800
    joined = simhash._rooted(distinct.withColumn("least", distinct.fp), simhash.closest(distinct)).withColumnRenamed("root", "group")
    root = brute.components(values, lambda a, b: (a ^ b).bit_count() <= 2)
    assert {r["fp"]: r["group"] for r in joined.collect()} == root
    assert simhash.closest(distinct).count() <= 13 * len(values) and simhash.links(joined).count() <= len(values)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 120)] + [(7, 7), (205, 201), (201, 203)]
    found = connect(spark.createDataFrame(links, "a BIGINT, b BIGINT"))
    wanted = [(i, 0) for i in range(31)] + [(i, 100) for i in range(100, 120)] + [(201, 201), (203, 201), (205, 201)]
    assert dict(wanted) == {n: n for n, _ in wanted} | {r["node"]: r["root"] for r in found.collect()}


def test_gaps_round_trip():
    import numpy as np

    for cells in ([], [0], [0, 0], [254, 255, 255, 256, 511, 766, 1_000_000]):
        assert unpack_gaps(pack_gaps(np.array(cells, np.int64))).tolist() == cells


def test_sketch_loses_no_repeated_hash(spark, docs):
    import numpy as np

    hashes = np.random.default_rng(1).integers(0, 1 << 63, 3000, dtype=np.int64).view(np.uint64)

    def some(batch):
        return np.concatenate([hashes[:2000], hashes[:50]])

    bits = repeats(docs.coalesce(1).limit(1).select("text"), "text", some, 16).value
    passed = bits.test(hashes)
    assert passed[:50].all() and passed[50:].mean() < 0.05


def test_repeated_hashes_are_told_exactly_however_many_there_are(spark):
    import numpy as np

    # The least of some, as anchors have them: all lie in a small part of their range.
    hashes = np.unique(np.random.default_rng(2).integers(0, 1 << 58, 400_000, dtype=np.int64)).view(np.uint64)
    parts = [np.concatenate([hashes[i::4], hashes[:500], hashes[:3], hashes[600:601]]) for i in range(4)]
    texts = spark.createDataFrame([(str(i),) for i in range(4)], "text STRING").repartition(3)
    found = repeated(texts, "text", lambda batch: parts[int(batch.column("text")[0].as_py())], 1)
    wanted = sorted(prefixes(np.append(hashes[:500], hashes[600])).astype(np.int64).tolist())
    assert sorted(r[0] for r in found.collect()) == wanted
    bits = members(spark.createDataFrame([(h,) for h in wanted], "hash BIGINT"), "hash", bits_for(len(wanted))).value
    passed = bits.test(mix(prefixes(hashes)))
    assert passed[:500].all() and passed[600] and passed[601:].mean() < 0.06


def test_bits_for_grams_follow_their_number(spark, docs):
    rows = suffix.spans.numbered(docs, "doc_id", "text")
    bits = suffix.gram_sketch(rows).value
    assert bits.bits == 16 and [bits_for(n) for n in (0, 1 << 14, (1 << 14) + 1, 30_000_000, 1 << 40)] == [16, 16, 17, 27, 30]
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    with shuffles_dropped(spark):
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before


@pytest.mark.parametrize("bits", [28, 8])
def test_word_windows(docs, doc_rows, bits):
    found = windows.remove_repeated_windows(docs, bits=bits)
    assert tuples(found, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.windows(doc_rows), key=repr)


@pytest.mark.parametrize("batches, bits", [(1, 27), (3, 27), (9, 8)])
def test_byte_strings(docs, doc_rows, batches, bits):
    found = suffix.remove_repeated_strings(docs, batches=batches, bits=bits)
    assert tuples(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute.strings(doc_rows), key=repr)


def test_windows_that_differ_in_a_word_are_different(stored):
    # Thue-Morse letters: a word and its complement have one polynomial modulo 2^64, whatever the base.
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    tail = " ".join(f"w{i}" for i in range(19))
    texts = ["x" + "".join("ab"[b ^ turned] for b in bits) + " " + tail for turned in (0, 1)]
    of_words = [" ".join("ab"[b ^ turned] for b in bits) for turned in (0, 1)]
    found = windows.op8_windows(stored([(1, texts[0]), (2, texts[1]), (3, texts[1])]))
    assert tuples(found, "doc_id", "n_removed") == [(1, 0), (2, 0), (3, 20)]
    found = windows.remove_repeated_windows(stored([(1, of_words[0]), (2, of_words[1])]), 1024)
    assert tuples(found, "doc_id", "n_removed") == [(1, 0), (2, 0)]


def test_hashes_of_stretches():
    random.seed(5)
    words = [random.choice(["a", "b", "ab", "0123456789abcdef", "0123456789abcdefg", "0123456789abcdefh", "é" * 8, "é" * 9]) for _ in range(400)]
    for width in (1, 2, 3, 7, 20):
        made = windows.Words(pa.array([" ".join(words), None, "", " ".join(words[:50])]), width)
        texts = [tuple(words[i:i + width]) for i in range(401 - width)] + [tuple(words[i:i + width]) for i in range(51 - width)]
        for seed in (0, 1):
            hashes = made.hashes(made.windows, seed).tolist()
            assert len(hashes) == len(texts) and len(set(zip(texts, hashes, strict=True))) == len(set(texts)) == len(set(hashes))


def test_equal_windows_across_batches():
    rows = [(h, 7 << 32 | i, i, 100 * h + i) for h in range(3) for i in range(40)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("hash", "tail", "id", "row"), r, strict=True)) for r in rows[i:i + 7]]) for i in range(0, len(rows), 7)]
    found = [r for b in windows._later_of(iter(batches), 10) for r in b.to_pylist()]
    assert sorted(r["row"] for r in found) == [r[3] for r in rows if r[2]] and sum(r["n"] for r in found) == 117


def test_levels_grow_geometrically(spark, docs):
    rows = suffix.spans.numbered(docs, "doc_id", "text")
    entries = suffix.entries(rows, suffix.gram_sketch(rows, bits=8), "bigint")
    index = suffix.SuffixIndex(spark)
    for _ in range(7):
        index.add(entries)
    index._merge_equal()
    assert [n for n, _ in index.levels] == [4, 2, 1]
    index.close()


def test_repeated_rows_lose_one_copy(repeated, texts):
    rows = [(i, t) for i, t in enumerate(texts)] * 2
    assert tuples(windows.op8_windows(repeated), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.windows(rows), key=repr)
    assert tuples(suffix.op4_suffix(repeated), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute.strings(rows), key=repr)
    assert simhash.op3_simhash(repeated).count() == len(rows)


@pytest.mark.parametrize("operator", [exact.op5_exact_dedup, simhash.op3_simhash, windows.op8_windows, suffix.op4_suffix])
def test_empty_table(operator, empty):
    assert operator(empty).count() == 0
