import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from innsight.llm import simhash_dedup as sd
from innsight.llm.components import components


def brute_fp(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union_find(nodes, pairs):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_fingerprints_equal_brute_force():
    rng = random.Random(3)
    texts = [None, "", " \t\n", "One", "one two", "A b C d", "é É ß", "x " * 5000]
    texts += [" ".join(rng.choice("ab cd EF gh ij".split()) for _ in range(rng.randrange(60))) for _ in range(60)]
    assert [sd.fingerprint(t) for t in texts] == [brute_fp(t) for t in texts]
    assert sd.fingerprint("\x0b a\x1cb   c") == brute_fp("\x0b a\x1cb   c")


def test_every_link_is_found(spark):
    rng = random.Random(5)
    fps = {0, (1 << 64) - 1}
    for _ in range(150):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(4):
            y = x
            for b in rng.sample(range(64), rng.choice([1, 2, 2, 3, 4])):
                y ^= 1 << b
            fps.add(y)
    signed = [int(np.array(x, dtype=np.uint64).view(np.int64)) for x in sorted(fps)]
    distinct = spark.createDataFrame([(x,) for x in signed], "fp long")
    for bits in (2, 3, 4):
        want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i]
                if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits}
        got = [tuple(r) for r in sd.links(distinct, bits).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_the_index_is_never_broadcast(spark, tmp_path):
    """The exploded index is many times what Spark takes it for, however small the fingerprints' own file is."""
    spark.range(3000).selectExpr("id * 7919 * 104729 AS fp").write.parquet(f"{tmp_path}/fps")
    found = sd.links(spark.read.parquet(f"{tmp_path}/fps"), 2)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    found.collect()  # the plan that ran, after Spark has seen the sizes
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, 99), (99, 100), (7, 7)]
    pairs += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(300, 300 + i) for i in range(1, 30)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = {n for p in pairs for n in p if p[0] != p[1]}
    assert got == union_find(nodes, pairs)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_components(rows):
    fps = [brute_fp(t) for _, t in rows]
    n = len(rows)
    at = union_find(range(n), [(i, j) for i in range(n) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if at[j] == at[i] and rows[j][0] is not None]
        out.append((doc, fps[i], min(ids) if ids else None))
    return out


BODY = " ".join(f"tok{i * 37 % 101}" for i in range(300))
ROWS = [(5, BODY), (9, BODY), (2, BODY.replace("tok5 ", "other ", 1)), (7, None), (8, ""), (3, " "), (None, "alone here"),
        (4, "alone here"), (9, BODY), (6, "short"), (11, "x" * 300_000), (None, None), (12, BODY.upper())]


def test_classes_with_nulls_ties_and_repeats(docs_of):
    got = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in sd.simhash_components(docs_of(ROWS)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_components(ROWS)))


def test_one_of_each_group_stays(docs_of):
    docs = docs_of(ROWS)
    kept = sd.near_duplicates_removed(docs)
    assert kept.columns == docs.columns
    want = brute_components(ROWS)
    groups = {(c if c is not None else f"null {f}") for _, f, c in want}
    rows = kept.collect()
    assert len(rows) == len(groups)
    assert sorted(r.doc_id for r in rows) == sorted({c for _, _, c in want})


def test_empty_table(docs_of):
    assert sd.simhash_components(docs_of([])).collect() == []
    assert sd.near_duplicates_removed(docs_of([])).collect() == []


def test_query_against_brute_force(spark):
    from innsight.llm.queries import op6_simhash_dedup, table

    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, d, "documents").collect()]
    got = sorted((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in op6_simhash_dedup(spark, d).collect())
    assert got == sorted(brute_components(rows))


def test_no_pairs_inside_a_group_of_copies(spark, docs_of):
    docs = docs_of([(i, "the same text again and again") for i in range(500)])
    fps = sd.fingerprints(docs, 3).select("fp").distinct()
    assert sd.links(fps, 2).count() == 0
    got = sd.simhash_components(docs).agg(F.countDistinct("component_id"), F.max("component_id")).first()
    assert tuple(got) == (1, 0)


def test_removal_keeps_columns_of_any_name(spark):
    from innsight.llm import simhash_dedup as sd

    text = " ".join(f"word{i}" for i in range(40))
    df = spark.createDataFrame([(1, text, "a", 1, 2), (2, text, "b", 3, 4), (None, text, "c", 5, 6), (3, None, "d", 7, 8)],
                               "doc_id long, text string, `a.dot` string, __text_digest int, `row` int")
    got = sd.near_duplicates_removed(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == [(1, text, "a", 1, 2), (3, None, "d", 7, 8)]
