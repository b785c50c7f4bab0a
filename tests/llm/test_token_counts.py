import os
import tempfile

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from innsight.llm import token_counts as tc

GPT = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TOKENIZERS = {p: Tokenizer.from_file(p) for p in (GPT, WORDS)}


def brute(text, path=GPT):
    return len(TOKENIZERS[path].encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*"ab1é'. \n\t\xa0\x1c\u2003\u3000\u0301<|>s", "<|endoftext|>", "  ", " \u0301"]),
                max_size=40).map("".join))
def test_counts_equal_the_librarys(text):
    assert tc.count_tokens([text], GPT) == [brute(text)]
    assert tc.count_tokens([text], WORDS) == [brute(text, WORDS)]


def test_edges_and_cache(spark, docs_of):
    long = "antion the " * 60_000
    rows = [(1, "Hello there"), (2, None), (3, ""), (4, "Hello there"), (None, "x <|endoftext|> y"), (4, "Hello there"),
            (5, long), (6, " \n "), (7, "é́ 漢字 \U0001f600")]
    cache = os.path.join(tempfile.mkdtemp(prefix="cache-"), "c")
    docs = docs_of(rows)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit)
                 for r in tc.token_counts(docs, GPT, cache).collect())
    assert got == sorted((str(i), len((t or "").encode()), brute(t), brute(t) > 512) for i, t in rows)
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for _, t in rows})  # distinct texts, once each
    # a second run over old and new texts stores the new ones alone
    tc.token_counts(docs_of(rows + [(9, "new one")]), GPT, cache).collect()
    assert spark.read.parquet(cache).count() == stored.count() + 1 == len({t or "" for _, t in rows}) + 1
    # another tokenizer has rows of its own
    other = {r.doc_id: r.n_tokens for r in tc.token_counts(docs_of([(1, "Hello there")]), WORDS, cache).collect()}
    assert other == {1: brute("Hello there", WORDS)}


def test_stored_counts_are_used(spark, docs_of):
    cache = os.path.join(tempfile.mkdtemp(prefix="cache-"), "c")
    digest = tc.tokenizer_digest(GPT)
    content = docs_of([(1, "abc")]).select(tc.content_digest(__import__("pyspark").sql.functions.col("text"))).first()[0]
    spark.createDataFrame([(content, digest, 77)], tc.CACHE_SCHEMA).write.parquet(cache)
    assert tc.token_counts(docs_of([(1, "abc")]), GPT, cache).first().n_tokens == 77


def test_empty_table(docs_of):
    cache = os.path.join(tempfile.mkdtemp(prefix="cache-"), "c")
    assert tc.token_counts(docs_of([]), GPT, cache).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_against_the_library(spark, sf):
    from innsight.llm.queries import op1_token_counts, table

    d = f"/root/testdata/{sf}"
    texts = {r.doc_id: r.text for r in table(spark, d, "documents").collect()}
    got = op1_token_counts(spark, d).collect()
    assert len(got) == len(texts)
    assert all(r.n_tokens == brute(texts[r.doc_id]) and r.n_bytes == len(texts[r.doc_id].encode()) for r in got)
