import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from innsight.llm import spelling as sp


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute_counts(rows, thin=97):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = ascii_lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if thin and h % thin == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def neighbours(counts):
    """Near words by the words that are left when one code point goes: equal length or one less."""
    holes, out = {}, {w: set() for w in counts}
    for w in counts:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1:]), set()).add(w)
    for group in holes.values():
        for a in group:
            out[a] |= group - {a}
    for w in counts:
        for i in range(len(w)):
            if (shorter := w[:i] + w[i + 1:]) in counts:
                out[w].add(shorter)
                out[shorter].add(w)
    return out


def brute(counts):
    out, forms = {}, {}
    around = neighbours(counts)
    for w, n in counts.items():
        best = min(around[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * n else None
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, n, len(around[w]), counts.get(forms[w]))
    return out


def result(df):
    rows = df.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def test_near_definitions_agree():
    words = ["aaaaa", "aaaaaa", "aaaab", "abaaa", "aabaaa", "abcde", "abcdef", "bcdef", "abde", "abcdee"]
    around = neighbours(dict.fromkeys(words, 3))
    assert all((b in around[a]) == near(a, b) for a in words for b in words if a != b)


TEXTS = [(1, "colour Colour COLOUR colour color color color colours colours colours " * 3), (2, None), (3, ""), (4, "... 123"),
         (5, "größe größe größe grösse grösse grösse grösze grösze grösze"), (None, "colour colors colors colors"),
         (6, "÷÷÷÷÷ ÷÷÷÷÷× ×÷÷÷÷÷ " * 5), (6, "aaaaa aaaaaa aaaaab baaaaa aabaaa abaaa " * 4), (6, "É" * 7 + " " + "é" * 7)]


def test_small_texts_equal_brute_force(docs_of):
    assert result(sp.spelling_variants(docs_of(TEXTS), thin=97)) == brute(brute_counts(TEXTS))
    assert result(sp.spelling_variants(docs_of(TEXTS))) == brute(brute_counts(TEXTS, None))


def test_ties_and_chains(docs_of):
    text = "abcde " * 3 + "abcdf " * 6 + "abcdg " * 6 + "abhdf " * 13 + "ibhdf " * 30
    got = result(sp.spelling_variants(docs_of([(1, text)])))
    assert got["abcde"] == ("abcdf", "ibhdf", 3, 2, 6)  # a tie goes to the smaller word
    assert got["abcdg"][0] is None and got["ibhdf"] == (None, "ibhdf", 30, 1, None)


def test_hot_blocks_are_split(spark):
    """Blocks above the limit, down to middles of one code point, give the same words."""
    rng = np.random.default_rng(3)
    words = {"stem" + "".join(rng.choice(list("abcé"), k)) + "end" for k in (2, 3, 4, 5, 6) for _ in range(250)}
    words |= {w[3:] for w in words} | {"aaaaa" + "b" * i for i in range(9)} | {"x" * 3000, "x" * 3001, "x" * 2999 + "y"}
    counts = {w: int(rng.integers(3, 40)) for w in sorted(words)}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    expected = {w: x for w, x in brute(counts).items() if x[3]}
    for limit in (4, 100, 10_000):
        got = {r.word: (r.form, r.n_near) for r in sp.near_words(table, limit=limit).collect()}
        around = neighbours(counts)
        best = {w: min(around[w], key=lambda x: (-counts[x], x)) for w in expected}
        assert got == {w: (best[w], len(around[w])) for w in expected}


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abé", min_size=5, max_size=9), min_size=1, max_size=60))
def test_products_find_each_pair_once(words):
    """All words as members of all their blocks, run through the products in this process."""
    counts = {w: i % 7 + 3 for i, w in enumerate(sorted(words))}
    rows = []
    for w, n in counts.items():
        for longer in (False, True):
            length = len(w) - longer
            if length < 5:
                continue
            h = length // 2
            size = length + longer
            rows.append((w, n, length, longer, length - h, w[:h], ""))
            rows.append((w, n, length, longer, h, "", w[size - (length - h):]))
    block = pd.DataFrame(rows, columns=["word", "n", "length", "longer", "m", "before", "after"]).sort_values(sp.KEY)
    found = pd.concat(list(sp._near(iter([block]))) or [pd.DataFrame({"word": [], "n_near": []})])
    got = found.groupby("word")["n_near"].sum().to_dict()
    assert got == {w: len(a) for w, a in neighbours(counts).items() if a}


def test_empty_tables_and_ratio(docs_of):
    assert sp.spelling_variants(docs_of([])).collect() == []
    assert sp.spelling_variants(docs_of([(1, "ab cd")])).collect() == []
    with pytest.raises(ValueError):
        sp.spelling_variants(docs_of([]), ratio=1)


def test_very_long_text_and_word(docs_of):
    rows = [(1, "y" * 400_000 + " " + "word" * 2 + " " + "filler " * 200_000), (2, "fillers " * 5)]
    got = result(sp.spelling_variants(docs_of(rows)))
    assert got == {"filler": (None, "filler", 200_000, 1, None), "fillers": ("filler", "filler", 5, 1, 200_000)}


@pytest.mark.parametrize("d", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_brute_force(spark, d):
    from innsight.llm.queries import op11_spelling_variants, table

    rows = [(r.doc_id, r.text) for r in table(spark, d, "documents").collect()]
    assert result(op11_spelling_variants(spark, d)) == brute(brute_counts(rows))
