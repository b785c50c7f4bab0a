"""The pipeline stage by stage: each on all its predecessor kept, against brute force."""

import re
import tempfile
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from innsight.llm import queries, toxicity
from innsight.llm.common import stored

from .test_mixing import brute_targets
from .test_packing import check
from .test_quality_rules import brute as brute_quality
from .test_simhash_dedup import brute_components

W = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage on sf0.001, and the input's folder."""
    d = "/root/testdata/sf0.001"
    docs = queries.table(spark, d, "documents")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        nxt = stored(stage(spark, docs, d), f"test-{name}")
        out.append((name, docs, nxt))
        docs = nxt
    return d, out


def test_stages_and_columns(stages):
    _, found = stages
    assert [n for n, _, _ in found] == ["quality_rules", "toxicity", "simhash_dedup", "mixing", "packing"]
    assert all(after.columns == before.columns for _, before, after in found[:-1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_stage(stages):
    _, before, after = stages[1][0]
    want = [r for r in before.collect() if brute_quality(r.text)[-1]]
    assert sorted(map(str, after.collect())) == sorted(map(str, want)) != []


def test_toxicity_stage(spark, stages):
    d, found = stages
    _, before, after = found[1]
    rows = before.collect()
    p = toxicity.score_texts([r.text for r in rows], queries.toxicity_model(spark, d), {})
    assert sorted(map(str, after.collect())) == sorted(str(r) for r, x in zip(rows, p) if x < 0.5) != []


def test_dedup_stage(stages):
    _, before, after = stages[1][2]
    rows = before.collect()
    keep = {c for _, _, c in brute_components([(r.doc_id, r.text) for r in rows])}
    assert sorted(map(str, after.collect())) == sorted(str(r) for r in rows if r.doc_id in keep)


def test_mixing_stage(stages):
    _, before, after = stages[1][3]
    texts = {r.doc_id: r for r in before.collect()}
    size = defaultdict(int)
    for r in texts.values():
        size[r.source] += len(W.findall(r.text))
    taken, copies = defaultdict(int), Counter()
    for r in after.collect():
        whole = texts[r.doc_id]
        assert whole.text.startswith(r.text) and r.source == whole.source
        taken[r.source] += len(W.findall(r.text))
        copies[r.doc_id] += 1
    want = brute_targets(dict(size))
    assert max(copies.values()) <= 2
    assert all(abs(taken[s] - want[s]) <= max(3, 0.01 * want[s]) for s in want)


def test_packing_stage(stages):
    _, before, after = stages[1][4]
    lengths = check(after.collect(), [(r.doc_id, r.text) for r in before.collect()])
    assert sum(lengths) >= 0.95 * 4096 * len(lengths)


def test_run_gives_the_stages_rows(spark, stages):
    d, found = stages
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    got = corpus_pipeline.run(spark, d).select(*key).collect()
    assert sorted(map(str, got)) == sorted(map(str, found[-1][2].select(*key).collect()))


@pytest.mark.parametrize("rows", [
    [], [(1, None, "a"), (2, "", None)],
    [(i, " ".join(f"w{i * 7 % 13}x{k} the" for k in range(60)), s) for i, s in ((1, "a"), (2, None), (3, "b"))]
    + [(None, " ".join(f"n{k} and" for k in range(60)), "a"), (1, None, "a"), (4, "short", "c")]
    + [(5, " ".join(f"long{k}" for k in range(60_000)), "a")] * 2], ids=["empty", "textless", "odd"])
def test_odd_tables(spark, docs_of, rows):
    d = tempfile.mkdtemp(prefix="pipeline-")
    docs = docs_of(rows)
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, None, 1), (None, 0, 1)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{d}/labels.parquet")
    kept = {r[0] for r in rows if r[1] and brute_quality(r[1])[-1]}
    out = corpus_pipeline.run(spark, d)
    got = out.select(F.collect_set("doc_id"), F.max(F.col("doc_id").isNull())).first()
    assert set(got[0]) | ({None} if got[1] else set()) <= kept
    assert bool(kept) == (out.count() > 0)
