import hashlib
import re

import pytest

from innsight.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, n=10):
    grams = {}
    for item, text in items:
        w = words(text)
        k = min(n, len(w))
        for p in range(len(w) - k + 1 if w else 0):
            grams.setdefault(tuple(w[p:p + k]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(g) for g in grams}:
            for p in range(len(w) - k + 1):
                if (g := tuple(w[p:p + k])) in grams:
                    hit.update(range(p, p + k))
                    found |= grams[g]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(map(str, out))


def got(df):
    return sorted(str((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in df.collect())


LONG = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, LONG), (20, "Only three words"), (3, None), (4, "..."), (5, LONG), (None, "a b c d e f g h i j k"),
         (20, "One"), (7, "x " * 12), (9, "éa öb " * 6)]
DOCS = [(1, None), (2, ""), (3, "clean text of no concern"), (4, LONG), (5, LONG.upper().replace(" ", "--\n")),
        (6, " ".join(LONG.split()[3:13]) + " mid " + " ".join(LONG.split()[20:29])), (7, "only THREE words, only three words"),
        (8, "one"), (None, "pre a b c d e f g h i j k post"), (None, "a b c"), (4, LONG), (4, "other text"),
        (9, "x " * 500), (10, "z " * 200_000 + LONG), (11, "ÉA ÖB " * 20 + "éa öb " * 9), (12, "under one roof")]


@pytest.fixture
def items_of(spark):
    from pyspark.sql import functions as F

    def make(rows):
        df = spark.createDataFrame(rows, "item_id long, text string")
        return df.withColumn("hash", F.lit("clash")).withColumn("doc_id", F.lit("clash"))
    return make


@pytest.mark.parametrize("broadcast_bytes", [dc.BROADCAST_BYTES, 0])
def test_small_tables_equal_brute_force(docs_of, items_of, broadcast_bytes):
    df = dc.contamination(docs_of(DOCS), items_of(ITEMS), broadcast_bytes=broadcast_bytes)
    assert got(df) == brute(DOCS, ITEMS)
    assert got(dc.contamination(docs_of(DOCS), items_of(ITEMS), n=4, broadcast_bytes=broadcast_bytes)) == brute(DOCS, ITEMS, 4)


def test_empty_tables(docs_of, items_of):
    assert dc.contamination(docs_of([]), items_of(ITEMS)).collect() == []
    assert got(dc.contamination(docs_of(DOCS), items_of([]))) == brute(DOCS, [])
    assert dc.without_documents(docs_of(DOCS), items_of([(1, None)])).count() == len(DOCS)


def test_spans_are_taken_out(docs_of, items_of):
    docs, items = docs_of(DOCS), items_of(ITEMS)
    out = dc.without_spans(docs, items)
    assert out.columns == docs.columns
    texts = [(r.doc_id, r.text) for r in out.collect()]
    assert len(texts) == len(DOCS)
    assert sorted((str(i), t) for i, t in texts if i in (1, 2, 3, 6, 7, 8, 12)) == [
        ("1", None), ("12", "under roof"), ("2", ""), ("3", "clean text of no concern"),
        ("6", " mid " + " ".join(LONG.split()[20:29])), ("7", ""), ("8", "")]
    assert "pre post" in [t for _, t in texts] and "z " * 200_000 in [t + " " for _, t in texts if t]
    # what is left of a text holds every word that wasn't hit, in order
    per_doc = {i: n for i, n in ((d, len(words(t))) for d, t in DOCS if d not in (None, 4))}
    hit = {r.doc_id: r.n_hit for r in dc.contamination(docs, items).collect()}
    assert all(len(words(t)) == per_doc[i] - hit[i] for i, t in texts if i in per_doc)


def test_documents_are_taken_out(docs_of, items_of):
    from pyspark.sql import functions as F

    docs, items = docs_of(DOCS).withColumn("a.dot", F.lit(1)), items_of(ITEMS)
    out = dc.without_documents(docs, items)
    clean = [x for x in DOCS if brute([x], ITEMS)[0].endswith("False)")]
    assert out.columns == docs.columns and 0 < len(clean) < len(DOCS)
    assert sorted(str((r.doc_id, r.text)) for r in out.collect()) == sorted(map(str, clean))


def test_query_against_sql_and_brute_force(spark):
    from innsight.llm.queries import QUERIES, table
    from innsight.llm.sql import ORACLE_SQL
    from innsight.oracle.compare import compare, duckdb_connection

    d, name = "/root/testdata/sf0.01", "op12_decontamination"
    df = QUERIES[name](spark, d)
    found = compare(name, df, duckdb_connection(d), ORACLE_SQL[name])
    assert found.ok, str(found)
    docs = [(r.doc_id, r.text) for r in table(spark, d, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, d, "benchmark").collect()]
    assert got(df) == brute(docs, items) and any(r.contaminated for r in df.collect())


def test_main_path_runs_no_python(spark):
    from innsight.llm.queries import op12_decontamination

    plan = op12_decontamination(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
