"""The pipeline, stage by stage, each against a plain version on its own input."""

import re
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from scoreline.llm import mixing, packing, toxicity
from scoreline.llm.common import settle

from . import brute

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, texts):
    """Documents with copies, near copies, toxic texts and repeated rows, and labels of some."""
    path = tmp_path_factory.mktemp("corpus")
    plain = [t for t in texts if t and 50 < len(t) < 5000]
    bad = ["you idiot and moron", "pathetic worthless clown", "idiot scum", "moron and worthless trash"]
    rows, labels = [], []
    for i in range(240):
        text = f"{plain[i % len(plain)]} {i * 7919}"
        if i % 4 == 0:
            text += " " + bad[i // 4 % 4] + " " + bad[(i // 4 + 1) % 4]
        rows.append((i, text))
        labels.append((i, 1, int(i % 4 == 0)))
    rows += [(500 + i, t) for i, t in enumerate(texts)] + [(900 + i, rows[i][1].upper() if i % 2 else rows[i][1]) for i in range(30)] + rows[5:9] + [(None, texts[8])]
    wide = [(k, t, ["en", "de", None][i % 3], f"src{i % 5}", len(t or ""), "x", 1) for i, (k, t) in enumerate(rows)]
    spark.createDataFrame(wide, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, _key STRING, _own INT").repartition(
        3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.fixture(scope="module")
def stages(spark, folder):
    """What goes into each stage and what comes out, as (name, input, output) DataFrames."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made = settle(stage(spark, docs, folder), "test-stage")
        out.append((name, docs, made))
        docs = made
    return {name: (before, after) for name, before, after in out}


def rows_in(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=repr)


def test_columns_stay(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "simhash_near_dedup", "mixing", "packing"]
    for name in names[:-1]:
        before, after = stages[name]
        assert after.dtypes == before.dtypes and after.count() < before.count()


def test_toxic_documents_go(spark, folder, stages):
    before, after = stages["toxicity"]
    scores = {r["doc_id"]: r["predicted"] for r in toxicity.op1_toxicity(before, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    assert rows_in(after) == [r for r in rows_in(before) if not scores[r[0]]]
    assert all(bool(scores[i]) == (i % 4 == 0) for i in range(240))


def test_one_of_equal_texts_stays(stages):
    before, after = stages["exact_dedup"]
    best = {}
    for key, text in rows_in(before):
        low = brute.lower(text)
        if low not in best or (key is not None and (best[low][0] is None or key > best[low][0])):
            best[low] = (key, text)
    assert rows_in(after) == sorted(best.values(), key=repr)


def test_one_of_near_copies_stays(stages):
    before, after = stages["simhash_near_dedup"]
    rows = rows_in(before)
    prints = {k: brute.fingerprint(t) for k, t in rows if k is not None}
    root = brute.components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert [r for r in rows_in(after) if r[0] is not None] == [r for r in rows if r[0] is not None and root[r[0]] == r[0]]


def test_the_sample_is_the_calibrated_one(stages):
    before, after = stages["mixing"]
    rows = mixing.op2_mixing(before).toPandas()
    cells = rows.groupby(["source", "lang", "topic"], as_index=False)["tokens"].sum()
    chance = mixing.calibrate(cells, mixing.TEMPERATURES, mixing.BUDGET).set_index(["source", "lang", "topic"])["probability"]
    draws = {r["doc_id"]: r["u"] for r in before.select("doc_id", mixing.draw(before.doc_id, 7).alias("u")).collect()}
    wanted = {None if r.doc_id != r.doc_id else int(r.doc_id) for r in rows.itertuples()
              if draws[None if r.doc_id != r.doc_id else int(r.doc_id)] < chance[r.source, r.lang, r.topic]}
    assert {k for k, _ in rows_in(after)} == wanted


def test_every_token_is_packed(stages):
    before, after = stages["packing"]
    tokenizer, pieces = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY)), defaultdict(int)
    for r in after.collect():
        pieces[r["doc_id"]] += r["length"]
    assert pieces == {k: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for k, t in rows_in(before)}


def test_run_is_the_stages(spark, folder, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"]
    one = corpus_pipeline.run(spark, folder)
    assert sorted(one.drop("sequence_id", "offset").collect(), key=repr) == sorted(stages["packing"][1].drop("sequence_id", "offset").collect(), key=repr)
    assert set(columns) <= set(one.columns)


def test_empty_documents(spark, folder, tmp_path):
    for table in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_decisions_hold_for_rows_not_for_doc_ids(spark, folder, stored, tmp_path):
    """Toxic and clean texts, near copies, and cells that share a doc_id or have none."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean, toxic = docs.where("doc_id = 1").first()["text"], docs.where("doc_id = 4").first()["text"]
    more = [(None, toxic), (None, clean + " one"), (None, clean + " two"), (7000, toxic), (7000, clean + " three")]
    wide = [(k, t, "en", "src0", len(t), "x", 1) for k, t in more]
    docs.unionByName(spark.createDataFrame(wide, docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    kept = rows_in(corpus_pipeline.drop_toxic(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), folder))
    assert [(k, t) in kept for k, t in more] == [False, True, True, False, True]


@pytest.mark.parametrize("ids", [(5, 5, 5), (None, None, None), (None, 5, 5), (9, None, 9)])
def test_one_of_near_copies_stays_whatever_their_doc_ids(spark, stored, texts, ids):
    alone = [(5, "quite another text of its own"), (None, "and one more that nothing is near to")]
    before = stored([*((k, texts[8]) for k in ids), *alone])
    after = rows_in(corpus_pipeline.drop_near_copies(spark, before, ""))
    near = [k for k, t in after if t == texts[8]]
    assert near == [min((k for k in ids if k is not None), default=None)] and all(r in after for r in alone)


def test_rows_of_one_doc_id_are_drawn_by_their_cells(spark, monkeypatch):
    path = settle(spark.range(400).selectExpr("id % 200 AS doc_id", "'some words' AS text", "'en' AS lang", "IF(id < 200, 'rare', 'common') AS source"), "cells")
    wishes = {"source": {"rare": 0.9, "common": 0.1}, "lang": {"en": 1.0}, "topic": {"prose": 1.0}}
    monkeypatch.setattr(mixing, "op2_mixing", lambda docs: mixing.mix(docs, wishes, 0.5))
    chosen = sorted((r["doc_id"], r["source"]) for r in mixing.op2_mixing(path).where("selected").collect())
    after = sorted((r["doc_id"], r["source"]) for r in corpus_pipeline.draw_mixture(spark, path, "").collect())
    assert after == chosen and len({k for k, _ in chosen}) < 200


def test_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert names["pipeline"] is corpus_pipeline.run


def test_nothing_else_needs_the_package():
    """The library and the entry import with the package and the pipeline out of reach."""
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("scoreline.llm"):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
assert len(entry.queries()) > 150 and set(entry.oracle_sql()) <= set(entry.queries()) and "pipeline" not in entry.queries()
"""
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, timeout=120).returncode == 0
    for file in (ROOT / "scoreline").rglob("*.py"):
        assert file.parent.name == "llm" or not re.search(r"\bllm\b", file.read_text())
