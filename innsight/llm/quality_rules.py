"""Quality rules as a short-circuit cascade.

Each rule is a predicate that rejects a text, by measures of it that are taken when first asked for. On a sample, every
rule's rejection rate and its marginal time are measured, that is the time beside what is measured of every text anyway;
the cascade then runs the rules by rejections per second, most first, and stops at a text's first rejection: rules after
it, and the measures that only they need, cost nothing. The order changes the work, never the verdict: a text is kept if
no rule rejects it.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")


class Text:
    """A text whose measures are computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self._known: dict[str, object] = {}

    def __getattr__(self, name: str):
        known = self.__dict__["_known"]
        if name not in known:
            try:
                known[name] = _MEASURES[name](self)
            except KeyError:
                raise AttributeError(name) from None
        return known[name]

    def take(self, names: Sequence[str]) -> list:
        """These measures, taken now if they weren't."""
        return [getattr(self, n) for n in names]

    def taken(self) -> frozenset[str]:
        """The measures taken so far."""
        return frozenset(self._known)


def _dup_lines(t: Text) -> int:
    lines = [x for x in t.text.split("\n") if _WORD.search(x)]
    return len(lines) - len(set(lines))


def _repeat_words(t: Text) -> int:
    """Words inside 3-word windows that occur twice or more."""
    w = t.words
    windows = list(zip(w, w[1:], w[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    n, end = 0, 0  # covered words so far, and the place after the last of them
    for i, x in enumerate(windows):
        if seen[x] > 1:
            n += i + 3 - max(i, end)
            end = i + 3
    return n


_MEASURES: dict[str, Callable[[Text], object]] = {
    "words": lambda t: _WORD.findall(t.text),
    "n_words": lambda t: len(t.words),
    "word_chars": lambda t: sum(map(len, t.words)),
    "n_symbols": lambda t: len(_SYMBOL.findall(t.text)),
    "n_dup_lines": _dup_lines,
    "n_lines": lambda t: sum(1 for x in t.text.split("\n") if _WORD.search(x)),
    "n_repeat_words": _repeat_words,
}


@dataclass(frozen=True)
class Rule:
    """``rejects`` says whether a text fails the rule."""

    name: str
    rejects: Callable[[Text], bool]


#: The rules every document must pass.
BASE_RULES = (
    Rule("too_short", lambda t: t.n_words < 50),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
)
#: The cascade's own rules (ratios of published web-text filters; exact integer forms).
METHOD_RULES = (
    Rule("symbols_per_word", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 12 * t.n_words),
    Rule("repeated_lines", lambda t: 2 * t.n_dup_lines > t.n_lines),
)


def order_rules(texts: Sequence[str | None], rules: Sequence[Rule],
                given: Sequence[str] = ()) -> list[tuple[Rule, float, float]]:
    """Rules with (seconds per text, share rejected) on a sample, by rejections per second, most first.

    A rule's time is marginal: measures in ``given`` are taken of every text anyway and are there before the clock starts.
    Otherwise every rule has texts of its own, so that none profits from what another has measured. Without a sample,
    and among equals, the given order holds."""
    found = []
    for r in rules:
        fresh = [Text(t) for t in texts]
        for t in fresh:
            t.take(given)
        began = time.perf_counter()
        rejected = sum(map(r.rejects, fresh))
        cost = (time.perf_counter() - began) / max(1, len(texts))
        found.append((r, cost, rejected / max(1, len(texts))))
    return sorted(found, key=lambda x: -x[2] / max(x[1], 1e-9))


def sample_texts(docs: DataFrame, text_col: str = "text", n: int = 300, max_chars: int = 100_000) -> list[str]:
    """About ``n`` texts for the estimates, ``2 * n`` at most, chosen by a digest, so spread over the whole table (texts
    over ``max_chars`` are left out of them). The sample serves the order of the rules alone; which documents are kept
    doesn't depend on it."""
    every = max(1, docs.count() // n)
    chosen = F.pmod(F.xxhash64(F.lit("quality sample"), F.col(text_col)), F.lit(every)) == 0
    return [r[0] for r in docs.where(chosen & (F.length(F.col(text_col)) <= max_chars))
            .select(F.col(text_col)).limit(2 * n).collect()]


def first_rejection(t: Text, rules: Sequence[Rule]) -> str | None:
    """Name of the first rule that rejects the text; the rules after it are not evaluated."""
    return next((r.name for r in rules if r.rejects(t)), None)


def cascade_order(docs: DataFrame, rules: Sequence[Rule], text_col: str = "text", given: Sequence[str] = ()) -> list[Rule]:
    """``rules`` in the order in which the cascade runs them over ``docs``."""
    return [r for r, _, _ in order_rules(sample_texts(docs, text_col), rules, given)]


#: The measures that ``judge`` returns of every text.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judgement(t: Text, base: Sequence[Rule], ordered: Sequence[Rule]) -> list:
    """The returned measures, base_failed and kept. All rules run in ``ordered`` up to the first that rejects; only a text
    that another rule than a base rule rejects is asked for the rest of those, as base_failed is returned too."""
    measures = t.take(MEASURES)
    rejection = first_rejection(t, ordered)
    failed = rejection is not None and (rejection in {r.name for r in base} or first_rejection(t, base) is not None)
    return [*measures, failed, rejection is None]


def keep(docs: DataFrame, rules: Sequence[Rule] = BASE_RULES + METHOD_RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns.

    Null text is the empty text, which ``too_short`` rejects. Repeated rows and null ids are judged by themselves;
    an empty table stays empty."""
    ship(docs.sparkSession)
    ordered = cascade_order(docs, rules, text_col)

    @F.pandas_udf("boolean")
    def kept(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([first_rejection(Text(t), ordered) is None for t in s], dtype=bool)

    return docs.where(kept(F.col(text_col)))


def judge(docs: DataFrame, base: Sequence[Rule] = BASE_RULES, rules: Sequence[Rule] = METHOD_RULES,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the base measures, base_failed and kept.

    The returned measures are taken of every document. All rules, the base ones among them, are ordered by their marginal
    cost given those, and run up to the first rejection, so what only a later rule needs isn't measured. Null and empty texts have no words and fail; rows with null or repeated ids stay rows of their own; columns
    other than id and text are not read."""
    ship(docs.sparkSession)
    ordered = cascade_order(docs, [*base, *rules], text_col, MEASURES)

    @F.pandas_udf(", ".join(f"{n} long" for n in MEASURES) + ", base_failed boolean, kept boolean")
    def judged(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            yield pd.DataFrame([judgement(Text(x), base, ordered) for x in s], columns=[*MEASURES, "base_failed", "kept"])

    return (docs.select(F.col(id_col).alias("doc_id"), judged(F.col(text_col)).alias("q"))
            .select("doc_id", "q.*"))
