import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from innsight.llm import toxicity as tx


def brute_kernel(a, b):
    """Subsequence kernel by enumeration."""
    def features(s):
        out = {}
        for i in range(len(s)):
            for j in range(i + 1, min(len(s), i + tx.MAX_GAP + 1)):
                for k in range(j + 1, min(len(s), j + tx.MAX_GAP + 1)):
                    key = s[i] + s[j] + s[k]
                    out[key] = out.get(key, 0.0) + tx.DECAY ** (k - i - 2)
        return out
    x, y = features(a), features(b)
    dot = lambda p, q: sum(v * q.get(u, 0.0) for u, v in p.items())
    return dot(x, y) / max(1e-12, dot(x, x) * dot(y, y)) ** 0.5


WORDS = ["idiot", "idixot", "id", "moronic", "aaaaaa", "abcabcabc", "^loser$", "^stupid$", "zebra"]


def test_kernel_equals_enumeration():
    got = tx.kernel(WORDS, WORDS[::-1])
    want = [[brute_kernel(a, b) for b in WORDS[::-1]] for a in WORDS]
    assert np.allclose(got, want)


def test_segments():
    assert tx.letters("Íd1ôt!") == "idiot" and tx.letters("x%%%") == "x"
    assert tx.words_of("you i d i o t man") == {"you", "i", "d", "o", "t", "man", "idiot"}
    assert tx.segments_of("ab") == [] and tx.segments_of("idiot.") == ["^idiot$"]
    long = "abcdefghij" * 5
    windows = tx._windows(long)
    assert all(long[i:i + 9] in "|".join(windows) for i in range(len(long) - 8))


def corpus(n, seed, insults=("worthless", "scumbag", "moron", "pathetic", "clownish")):
    rng = random.Random(seed)
    syllables = "an ti on ea re th ble ing er st wh ly ou nd ed".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    out = []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(15, 80))]
        y = int(i % 5 == 0)
        for _ in range(rng.randrange(2, 5) if y else 0):
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        out.append((" ".join(words) + ".", y))
    return out


@pytest.fixture(scope="module")
def model():
    return tx.fit(corpus(500, 1))


def test_held_out_texts(model):
    texts = corpus(400, 2)
    p = tx.score_texts([t for t, _ in texts], model, {})
    y = np.array([y for _, y in texts])
    assert ((p >= 0.5) == y).mean() >= 0.97 and ((p >= 0) & (p <= 1)).all()


def test_gapped_and_inserted_characters(model):
    base = "anti onea there was an ingly thing and"
    for insult in ("w o r t h l e s s", "m.o.r.o.n", "m0ron", "path-etic", "scumbaag", "worthlless"):
        assert tx.score_texts([f"{base} {insult} onea"], model, {})[0] > 0.5, insult
    assert tx.score_texts([base], model, {})[0] < 0.5


def test_score_is_that_of_the_worst_segment_wherever_it_stands(model):
    filler = "anti onea there ingly " * 20_000
    assert tx.score_texts([filler + "moron"], model, {}) == tx.score_texts(["moron"], model, {})
    assert len(set(tx.score_texts([None, "", "  ", "é 1", "??"], model, {}).tolist())) == 1


def test_fit_is_reproducible_and_needs_two_classes():
    texts = corpus(120, 3)
    a, b = tx.fit(texts), tx.fit(texts[::-1])
    assert np.array_equal(a.table, b.table) and (a.bias, a.slope, a.offset) == (b.bias, b.slope, b.offset)
    for one in ([], [("text", 0)], [("text", 1)], [("", 0), ("", 1)]):
        p = tx.score_texts(["any", None], tx.fit(one), {})
        assert p[0] == p[1] and 0 < p[0] < 1


def test_operator_with_nulls_and_repeats(model, docs_of):
    rows = [(1, "a moron here"), (2, None), (None, "moron"), (1, "a moron here"), (3, "")]
    docs = docs_of(rows)
    got = tx.toxicity(docs, model).collect()
    assert sorted((str(r.doc_id), r.held_out, r.predicted) for r in got) == sorted(
        (str(i), i is not None and zlib.crc32(str(i).encode()) % 5 == 0, int("moron" in (t or ""))) for i, t in rows)
    kept = tx.clean(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert tx.toxicity(docs_of([]), model).collect() == [] == tx.clean(docs_of([]), model).collect()


def test_training_rows_leave_the_held_out_fold(spark, docs_of):
    rows = [(i, f"text {i}") for i in range(100)] + [(None, "x"), (7, "text 7")]
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(120)] + [(None, 1, 1), (5, None, None)],
                                   "doc_id long, quality int, toxic int")
    got = tx.training_rows(docs_of(rows), labels, toxic=10, clean=500)
    ids = [int(t.split()[1]) for t, _ in got]
    assert all(zlib.crc32(str(i).encode()) % 5 for i in ids) and len(set(ids)) == len(ids)
    assert all(y == i % 2 for i, (_, y) in zip(ids, got)) and sum(y for _, y in got) == 10
    clean = {i for i in range(0, 100, 2) if zlib.crc32(str(i).encode()) % 5}
    assert {i for i in ids if i % 2 == 0} == clean


def test_query_on_the_held_out_fold(spark):
    from innsight.llm.queries import op2_toxicity, table

    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in table(spark, d, "labels").collect()}
    got = op2_toxicity(spark, d).collect()
    assert len(got) == table(spark, d, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    told = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    toxic = [p for y, p in told if y]
    clean = [p for y, p in told if not y]
    assert np.mean(toxic) >= 0.9 and np.mean(clean) <= 0.03  # 6 of the 97 rows labelled toxic hold no insult
    assert all(r.predicted == int(r.score >= 0.5) for r in got)
