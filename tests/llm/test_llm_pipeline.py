"""The pipeline's rows against plain Python, stage by stage, and the registered queries."""

import collections
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__
import corpus_pipeline
from filinglake.llm import near_dedup, packing, queries, toxicity
from tests.llm.conftest import prose
from tests.llm.test_llm_decontaminate import brute
from tests.llm.test_llm_texts import PII, fits


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with copies, near copies, leaks, personal data and toxic texts."""
    insults = ["dunce", "lout", "oaf"]
    rows = [(i, prose(i, 60 + i)) for i in range(90)]
    for i in range(90, 130):
        words = prose(i, 80).split()
        words[5::20] = insults[:1] * len(words[5::20])
        rows.append((i, " ".join(words + insults)))
    rows += [(200 + i, rows[i][1]) for i in range(5)]
    rows += [(300 + i, rows[80 + i][1] + " tail") for i in range(5)]
    items = [(i, prose(700 + i, 30)) for i in range(6)]
    rows += [(400 + i, f"{prose(800 + i, 40)} {items[i][1]} {prose(900 + i, 40)}") for i in range(6)]
    rows += [(500, "write to a@b.co or +1 (017) 555-7713 " + prose(1, 30)), (501, None), (502, ""), (503, "10.0.0.1")]
    at = tmp_path_factory.mktemp("tables")
    docs = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG").write.parquet(f"{at}/documents.parquet")
    labels = [(i, 1, int(90 <= i < 130)) for i in range(130)]
    spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(items, "item_id LONG, text STRING").write.parquet(f"{at}/benchmark.parquet")
    return str(at), items


def test_stages_one_by_one(spark, folder):
    path, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "decontamination", "sanitise", "packing"] and corpus_pipeline.ORACLE_SQL is None
    steps = dict(corpus_pipeline.STAGES)
    before = {r.doc_id: r.text for r in docs.collect()}

    model = toxicity.train(docs, spark.read.parquet(f"{path}/labels.parquet"))
    ids = list(before)
    z = model.logits(*toxicity.features(pa.array([before[i] for i in ids], pa.string())))
    civil = steps["toxicity"](spark, docs, path).cache()
    assert civil.columns == docs.columns
    kept = {r.doc_id for r in civil.collect()}
    assert kept == {i for i, logit in zip(ids, z, strict=True) if 1 / (1 + np.exp(-logit)) < toxicity.REJECT}
    assert kept == {i for i in ids if not 90 <= i < 130}

    known = near_dedup.frequencies(civil.select("text"))
    root = {i: i for i in sorted(kept)}
    for a, b in itertools.combinations(sorted(kept), 2):
        same = (before[a] or "") == (before[b] or "")
        if same or (before[a] and before[b] and near_dedup.similarities(pa.array([before[a]]), pa.array([before[b]]), known)[0] >= 0.8):
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = {i: new if r == old else r for i, r in root.items()}
    single = steps["near_dedup"](spark, civil, path).cache()
    assert {r.doc_id for r in single.collect()} == set(root.values())

    left = [(i, before[i]) for i in set(root.values())]
    clean = steps["decontamination"](spark, single, path).cache()
    leaked = {i for i, _ in brute(left, items)}
    assert leaked >= {400 + i for i in range(6)}
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in left} - leaked

    private = steps["sanitise"](spark, clean, path).cache()
    assert private.columns == docs.columns
    for row in private.collect():
        held = [k for k, p in PII.items() for m in re.finditer(p, before[row.doc_id] or "") if fits(k, m[0])]
        if held:
            assert all(f"[{k.upper()}]" in row.text for k in held)
        else:
            assert row.text == before[row.doc_id]

    texts = {r.doc_id: r.text for r in private.collect()}
    want = collections.Counter()
    for i, text in texts.items():
        whole = np.array([*packing.encoder().encode_ordinary(text or ""), 1], "<u4")
        for start in range(0, len(whole), 2048):
            own = whole[start : start + 2048]
            want[i, start, len(own), zlib.crc32(own.tobytes())] += 1
    packed = collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in steps["packing"](spark, private, path).collect())
    assert packed == want
    ran = corpus_pipeline.run(spark, path)
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in ran.collect()) == want


def test_empty_tables(spark, folder, tmp_path):
    path, _ = folder
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 11)} == {name.split("_")[0] for name in names if re.match(r"op\d+_", name)}
    assert names["pipeline"] is corpus_pipeline.run
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
