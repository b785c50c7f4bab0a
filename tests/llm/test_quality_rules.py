import re
from collections import Counter

from innsight.llm import quality_rules as qr

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = W.findall(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(3)}
    seen, dup, lines = set(), 0, 0
    for x in text.split("\n"):
        if W.search(x):
            lines += 1
            dup += x in seen
            seen.add(x)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    chars, symbols = sum(map(len, w)), sum(c in "#*$%&|<>" for c in text)
    kept = not failed and 10 * symbols <= len(w) and 2 * len(w) <= chars <= 12 * len(w) and 2 * dup <= lines
    return len(w), chars, symbols, dup, len(covered), failed, kept


BASE = " ".join(f"word{i} then" for i in range(40))
TEXTS = [None, "", " \n\t", "one two", BASE, BASE + " #$%" * 30, "a b c " * 30, BASE + "\nline\nline\n\nline",
         "x" * 200_000, ("é" * 5 + " ") * 60, "\n".join(["same line here now"] * 40 + [BASE]), BASE * 400]


def test_measures_and_verdicts(docs_of):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, BASE), (4, BASE)]
    got = [tuple(r) for r in qr.judge(docs_of(rows)).collect()]
    assert sorted(map(str, got)) == sorted(str((i, *brute(t))) for i, t in rows)


def test_keep_returns_whole_rows(docs_of):
    docs = docs_of([(i, t) for i, t in enumerate(TEXTS)] + [(None, BASE), (4, BASE)])
    kept = qr.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        [str(i) for i, t in enumerate(TEXTS) if brute(t)[-1]] + ["None", "4"])


def test_empty_table(docs_of):
    assert qr.judge(docs_of([])).collect() == [] and qr.keep(docs_of([])).collect() == []


def test_cheap_rejecting_rules_come_first_and_order_changes_no_verdict():
    import time

    calls = []
    slow = qr.Rule("slow", lambda t: calls.append(t) or time.sleep(0.002) or "a" in t.text)
    never = qr.Rule("never", lambda t: False)
    quick = qr.Rule("quick", lambda t: "b" in t.text)
    texts = ["a", "b", "ab", "c"] * 5
    ordered = [r for r, _, _ in qr.order_rules(texts, [slow, never, quick])]
    assert [r.name for r in ordered] == ["quick", "slow", "never"]
    calls.clear()
    verdicts = [qr.first_rejection(qr.Text(t), ordered) is None for t in texts]
    assert verdicts == [qr.first_rejection(qr.Text(t), [slow, never, quick]) is None for t in texts]
    assert sum("b" in t for t in texts) == 10


def test_short_circuit():
    later = qr.Rule("later", lambda t: 1 / 0)
    assert qr.first_rejection(qr.Text("x"), [qr.Rule("first", lambda t: True), later]) == "first"


def test_cascade_saves_evaluations():
    """Rules after the first rejection aren't evaluated, and what only they need isn't measured."""
    from collections import Counter

    calls = Counter()

    def counted(r):
        return qr.Rule(r.name, lambda t: calls.update([r.name]) or r.rejects(t))

    base, rules = [counted(r) for r in qr.BASE_RULES], [counted(r) for r in qr.METHOD_RULES]
    short, good = "too few words", " ".join(f"word{i}" for i in range(60))
    symbols = good + " # $ % & | < > * #" * 3
    ordered = [r for r, _, _ in qr.order_rules([short] * 6 + [symbols] * 3 + [good], [*base, *rules], qr.MEASURES)]
    assert ordered[0].name == "too_short" and ordered[1].name == "symbols_per_word"
    calls.clear()
    texts = [qr.Text(t) for t in [short] * 10 + [symbols] * 5 + [good] * 2]
    found = [qr.judgement(t, base, ordered)[-2:] for t in texts]
    assert found == [[True, False]] * 10 + [[False, False]] * 5 + [[False, True]] * 2
    # a text that another rule rejects is asked for the base rules left, as base_failed is returned
    assert calls["symbols_per_word"] == 7 and calls["word_length"] == calls["repeated_lines"] == 2
    assert calls["too_short"] <= 17 + 5 and calls["repeated_windows"] <= 7
    assert all(("n_lines" in t.taken()) == (i >= 15) for i, t in enumerate(texts))
    calls.clear()
    assert [qr.first_rejection(qr.Text(t), ordered) for t in [short] * 10] == ["too_short"] * 10
    assert calls == {"too_short": 10}


def test_sample_is_spread_over_the_table(docs_of):
    rows = [(i, f"text number {i}") for i in range(2000)]
    ids = {int(t.split()[-1]) for t in qr.sample_texts(docs_of(rows))}
    assert 200 < len(ids) <= 600 and min(ids) < 100 and max(ids) > 1900
    assert ids == {int(t.split()[-1]) for t in qr.sample_texts(docs_of(rows[::-1]))}


def test_query_against_brute_force(spark):
    from innsight.llm.queries import op5_quality_rules, table

    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in table(spark, d, "documents").collect()}
    got = op5_quality_rules(spark, d).collect()
    assert len(got) == len(texts) and all(tuple(r)[1:] == brute(texts[r.doc_id]) for r in got)


def test_clean_documents_stay(spark):
    from innsight.llm.queries import op5_quality_rules, table

    d = "/root/testdata/sf0.01"
    good = {r.doc_id for r in table(spark, d, "labels").where("quality = 1").collect()}
    bad = {r.doc_id for r in table(spark, d, "labels").where("quality = 0").collect()}
    got = op5_quality_rules(spark, d).collect()
    assert all(r.kept for r in got if r.doc_id in good and not r.base_failed)
    assert not any(r.kept for r in got if r.doc_id in bad)


def test_query_against_sql(spark):
    from innsight.llm.queries import QUERIES
    from innsight.llm.sql import ORACLE_SQL
    from innsight.oracle.compare import compare, duckdb_connection

    d, name = "/root/testdata/sf0.01", "op5_quality_rules"
    found = compare(name, QUERIES[name](spark, d), duckdb_connection(d), ORACLE_SQL[name])
    assert found.ok, str(found)
