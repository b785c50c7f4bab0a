"""Toxicity by a support vector machine with a subsequence string kernel and Nyström landmarks.

An instance is a segment of a sentence: a word, or a run of single letters read as one word. Two segments are as
alike as the three-letter subsequences that they share; a subsequence's letters may stand up to ``MAX_GAP`` places
apart and each place skipped costs a factor ``DECAY``, so a word with inserted characters stays near the word. The
kernel is normalised to 1 for equal segments. Landmark segments, chosen from the training sentences, span the
Nyström feature space; a linear SVM is trained there. A sentence is as toxic as its worst segment and a document as
its worst sentence. Which segments of a toxic sentence are toxic isn't labelled: training alternates between
choosing each sentence's worst segments under the current model and fitting the SVM to them and to the segments of
clean sentences (multiple-instance SVM).
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import released, ship

MAX_GAP = 3
CHANCE = 14.0
DECAY = 0.5
#: Longer words are read in windows of this many letters, each half overlapping the last.
WINDOW = 16
#: Letters are told apart in 32 classes: 0 none, a-z 1 to 26, a word's begin and end (written ^ and $) 27 and 28,
#: other scripts' letters share 29 to 31.
CLASSES = 32
_CLASS = {c: i + 1 for i, c in enumerate("abcdefghijklmnopqrstuvwxyz^$")}
_ASCII = np.array([0, *(_CLASS.get(chr(c)) or 29 + c % 3 for c in range(1, 128))])
_STEPS = [(g, h) for g, h in product(range(1, MAX_GAP + 1), repeat=2)]
_SINGLES = re.compile(r"(?<!\w)\w(?:[\W_]+\w(?!\w)){2,}")
_SENTENCE = re.compile(r"[.!?\n]+(?=\s|$)")
_DIGITS = str.maketrans("013457", "oieast")
_BUCKETS = 1 << 22
#: Words whose score a task remembers before it starts anew.
_MEMO = 300_000


def letters(word: str) -> str:
    """The word's letters in lower case without accents; digits that look like a letter count as it."""
    word = word.lower()
    if word.isascii() and word.isalpha():
        return word
    plain = unicodedata.normalize("NFKD", word.translate(_DIGITS))
    return "".join(c for c in plain if c.isalpha())


def _windows(s: str) -> list[str]:
    if len(s) <= WINDOW:
        return [s]
    return [s[i:i + WINDOW] for i in range(0, len(s) - WINDOW // 2, WINDOW // 2)]


def words_of(text: str) -> set[str]:
    """The text's distinct white-space words, and its runs of three or more single letters, spaces removed."""
    found = set(text.split())
    found.update(re.sub(r"[\W_]+", "", m) for m in _SINGLES.findall(text))
    return found


def segments_of(word: str) -> list[str]:
    s = letters(word)
    return _windows(f"^{s}$") if len(s) >= 3 else []


def _codes(segments: Sequence[str]) -> np.ndarray:
    width = WINDOW + 2 * MAX_GAP
    points = np.array(segments, dtype=f"<U{width}").view("<u4").reshape(len(segments), width)
    return np.where(points < 128, _ASCII[points & 127], 29 + points % 3).astype(np.int32)


def subsequences(segments: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, weights), one row per segment, in order of id; id 0 has weight 0. An id that occurs more than once in
    a row holds its summed weight at one place."""
    c = _codes(segments)
    n = WINDOW
    ids, weights = [], []
    for g, h in _STEPS:
        a, b, d = c[:, :n], c[:, g:n + g], c[:, g + h:n + g + h]
        ok = (a > 0) & (b > 0) & (d > 0)
        ids.append(np.where(ok, (a * CLASSES + b) * CLASSES + d, 0))
        weights.append(np.where(ok, DECAY ** (g + h - 2), 0.0).astype(np.float32))
    i, w = np.concatenate(ids, axis=1), np.concatenate(weights, axis=1)
    order = np.argsort(i, axis=1, kind="stable")
    i, w = np.take_along_axis(i, order, 1), np.take_along_axis(w, order, 1)
    last = np.ones(i.shape, dtype=bool)
    last[:, :-1] = i[:, 1:] != i[:, :-1]
    total = np.cumsum(w, axis=1, dtype=np.float64)
    start = np.where(last, total, 0.0)
    before = np.maximum.accumulate(np.concatenate([np.zeros((len(i), 1)), start[:, :-1]], axis=1), axis=1)
    return np.where(last, i, 0), np.where(last, total - before, 0.0) * (i > 0)


def kernel(segments: Sequence[str], landmarks: Sequence[str]) -> np.ndarray:
    """Normalised subsequence kernel between segments (rows) and landmarks (columns)."""
    li, lw = subsequences(landmarks)
    table = np.zeros((CLASSES ** 3, len(landmarks)))
    for j in range(len(landmarks)):
        np.add.at(table[:, j], li[j], lw[j])
    used = table.any(axis=1)
    used[0] = False
    norm_l = np.sqrt(np.maximum((lw ** 2).sum(1), 1e-12))
    out = np.zeros((len(segments), len(landmarks)))
    for a in range(0, len(segments), 256):  # rows of all subsequences times landmarks, so few at once
        i, w = subsequences(segments[a:a + 256])
        norm = np.sqrt(np.maximum((w ** 2).sum(1), 1e-12))
        row, col = np.nonzero(used[i])
        if len(row):
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            part = np.add.reduceat(w[row, col][:, None] * table[i[row, col]], starts, axis=0)
            out[a + row[starts]] = part / norm[row[starts], None] / norm_l
    return out


def _table(landmarks: Sequence[str], weights: np.ndarray) -> np.ndarray:
    """Decision value per subsequence for an SVM with these weights on the kernel values to the landmarks."""
    li, lw = subsequences(landmarks)
    lw = lw / np.sqrt(np.maximum((lw ** 2).sum(1, keepdims=True), 1e-12))
    table = np.zeros(CLASSES ** 3)
    np.add.at(table, li, lw * weights[:, None])
    table[0] = 0
    return table


@dataclass
class Model:
    """``table[id]`` is a subsequence's share of the decision value: the Nyström map and the SVM's weights
    multiplied out over the landmarks. ``slope`` and ``offset`` turn a document's worst value into a probability."""

    table: np.ndarray
    bias: float
    slope: float
    offset: float
    floor: float  # decision value of a text without segments

    def decide(self, segments: Sequence[str]) -> np.ndarray:
        out = np.empty(len(segments))
        for a in range(0, len(segments), 4096):
            i, w = subsequences(segments[a:a + 4096])
            norm = np.sqrt(np.maximum((w ** 2).sum(1), 1e-12))
            out[a:a + 4096] = (w * self.table[i]).sum(1) / norm + self.bias
        return out

    def probability(self, worst: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * worst + self.offset, -30, 30)))


def constant_model(share: float) -> Model:
    """For training rows that don't tell the classes apart: every text gets the smoothed share of toxic rows, but less
    than 0.5, as nothing speaks against it."""
    share = min(share, 0.49)
    return Model(np.zeros(CLASSES ** 3), 0.0, 0.0, float(np.log(share / (1 - share))), 0.0)


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, reg: float = 3e-3) -> tuple[np.ndarray, float]:
    """Linear SVM, squared hinge, by Newton steps; y is +1 or -1."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    theta = np.zeros(x1.shape[1])
    penalty = np.full(x1.shape[1], reg)
    penalty[-1] = 1e-6
    for _ in range(30):
        margin = 1 - y * (x1 @ theta)
        on = margin > 0
        xa, wa = x1[on], weight[on]
        grad = penalty * theta - xa.T @ (wa * y[on] * margin[on])
        step = np.linalg.solve(np.diag(penalty) + (xa * wa[:, None]).T @ xa + 1e-9 * np.eye(len(theta)), grad)
        theta -= step
        if np.abs(step).max() < 1e-6:
            break
    return theta[:-1], theta[-1]


def _stems(segment: str) -> set[str]:
    """Its substrings of five and six characters. A word's begin and end count as characters, so letters that many clean
    words hold inside may still tell a toxic word where they begin or end one."""
    return {segment[i:i + n] for n in (5, 6) for i in range(len(segment) - n + 1)} or {segment}


def _tell_tale(toxic: list[str], in_clean: Counter, suspicious: set[str], clean: int) -> dict[str, int]:
    """Stems that toxic documents have more often than chance would give, with their support: the documents that
    have the stem between neighbours (the words before and after) that no document before has it between. Near
    copies of one toxic document share neighbours, so what they have in common has little support. Clean documents
    with a word of the stem count three times against it."""
    def hits(text: str) -> Iterator[tuple[int, set[str]]]:
        """(hash of the neighbours, stems) of each suspicious word; told anew for each pass, to keep little."""
        words = text.split()
        for i, w in enumerate(words):
            if st := set().union(*(_stems(x) for x in segments_of(w) if x in suspicious)):
                yield hash((tuple(words[max(0, i - 1):i]), tuple(words[i + 1:i + 2]))), st

    least = CHANCE / np.log((len(toxic) + clean) / len(toxic))  # so many toxic and no clean ones, at odds of e^-CHANCE
    # a table of counts by hash, never too low, leaves out most stems before any is kept by name
    bound = np.zeros(_BUCKETS, dtype=np.int32)
    for text in toxic:
        found = {hash(s) % _BUCKETS for _, st in hits(text) for s in st}
        bound[np.fromiter(found, np.int64, len(found))] += 1
    in_docs: Counter = Counter()
    for text in toxic:
        in_docs.update({s for _, st in hits(text) for s in st if bound[hash(s) % _BUCKETS] >= least})
    often = {s for s, n in in_docs.items() if n >= least}
    del in_docs
    neighbours: dict[str, set[int]] = {s: set() for s in often}
    support: Counter = Counter()
    for text in toxic:
        here: dict[str, set[int]] = {}
        for context, st in hits(text):
            for s in st & often:
                here.setdefault(s, set()).add(context)
        for s, contexts in here.items():
            support[s] += neighbours[s].isdisjoint(contexts)
            neighbours[s] |= contexts
    against: Counter = Counter()
    for word, n in in_clean.items():
        for s in _stems(word) & often:
            against[s] += n
    penalty = 3 * len(toxic) / max(1, clean)
    return {s: n for s in sorted(often) if (n := support[s] - penalty * against[s]) >= least}


def _with_insertion(segment: str, rng: np.random.Generator) -> str:
    """The segment with a letter put in at random; training on such copies makes the SVM tolerate them."""
    i = int(rng.integers(2, max(3, len(segment) - 1)))
    return (segment[:i] + "abcdefghijklmnopqrstuvwxyz"[rng.integers(26)] + segment[i:])[:WINDOW]


def fit(documents: Sequence[tuple[str, int]], n_landmarks: int = 192, rounds: int = 7, seed: int = 7) -> Model:
    """Train on (text, label) pairs. The result depends on the pairs alone."""
    documents = sorted(documents)
    n1 = sum(1 for _, y in documents if y)
    if not documents or n1 in (0, len(documents)):
        return constant_model((n1 + 1) / (len(documents) + 2))
    rng = np.random.default_rng(seed)
    sets = [{s for sentence in _SENTENCE.split(text) for w in words_of(sentence) for s in segments_of(w)}
            for text, _ in documents]
    toxic = [s for s, (_, y) in zip(sets, documents) if y]
    clean = [s for s, (_, y) in zip(sets, documents) if not y]
    if not any(toxic) or not any(clean):
        return constant_model((n1 + 1) / (len(documents) + 2))
    in_toxic, in_clean = Counter(), Counter()
    for d in toxic:
        in_toxic.update(d)
    for d in clean:
        in_clean.update(d)
    often = 5 * len(toxic) / len(clean)
    suspicious = {s for s, n in in_toxic.items() if n > often * in_clean[s]}
    stems = _tell_tale([t for t, y in documents if y], in_clean, suspicious, len(clean))
    witnesses = sorted(s for s in suspicious if not _stems(s).isdisjoint(stems))
    if not witnesses:
        return constant_model((n1 + 1) / (len(documents) + 2))
    common = sorted(in_clean)
    worst_first = sorted(witnesses, key=lambda s: (-in_toxic[s], s))[:n_landmarks // 2]
    drawn = [common[i] for i in rng.permutation(len(common))[:n_landmarks // 4]]
    hardest: list[str] = []

    names = sorted(set().union(*sets))
    place = {s: i for i, s in enumerate(names)}
    toxic_ids = [np.array([place[x] for x in sorted(d)]) for d in toxic if d]
    is_clean = np.array([x not in suspicious for x in names])
    clean_ids = np.flatnonzero(is_clean)
    hard = clean_ids[rng.permutation(len(clean_ids))[:4000]]
    pos = np.array(sorted(place[x] for x in witnesses))
    for _ in range(rounds):
        marks = list(dict.fromkeys(worst_first + hardest + drawn))
        vals, vecs = np.linalg.eigh(kernel(marks, marks))
        whiten = vecs[:, vals > 1e-6] / np.sqrt(vals[vals > 1e-6])
        neg = np.setdiff1d(hard, pos)
        varied = [_with_insertion(names[i], rng) for i in pos]
        x = kernel([names[i] for i in pos] + varied + [names[i] for i in neg], marks) @ whiten
        y = np.r_[np.ones(2 * len(pos)), -np.ones(len(neg))]
        count1 = np.array([in_toxic[names[i]] for i in pos] * 2, dtype=float)  # the more documents, the more weight
        count0 = np.sqrt([in_clean[names[i]] for i in neg])
        w, b = _svm(x, y, np.r_[50 * count1 / count1.sum(), 50 * count0 / max(1, count0.sum())])
        model = Model(_table(marks, whiten @ w), float(b), 1.0, 0.0, 0.0)
        value = model.decide(names)
        # witnesses that the model doesn't bear out go; each toxic document's worst segment is one, unless clean
        # documents have it
        pos = pos[value[pos] > 0]
        best = np.array([ids[value[ids].argmax()] for ids in toxic_ids])
        pos = np.union1d(pos, best[~is_clean[best] & (value[best] > 0)])
        near = clean_ids[np.argsort(-value[clean_ids], kind="stable")[:1000]]  # clean, but most like toxic ones
        hard = np.union1d(hard, near)
        hardest = [names[i] for i in near[:n_landmarks // 4]]

    floor = float(value.min())
    top = np.array([max((value[place[s]] for s in found), default=floor) for found in sets])
    target = np.array([y for _, y in documents], dtype=float)
    slope, offset = _platt(top, target)

    return Model(model.table, model.bias, slope, offset, floor)


def _platt(value: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic calibration with softened targets."""
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.full(len(y), 1 / len(y))
    x = np.stack([value, np.ones_like(value)], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (weight * (p - t)) + 1e-4 * theta * [1, 0]
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag([1e-4, 1e-9])
        step = np.linalg.solve(hess, grad)
        theta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-7:
            break
    return float(theta[0]), float(theta[1])


def training_rows(docs: DataFrame, labels: DataFrame, toxic: int = 1000, clean: int = 2000, max_chars: int = 20_000,
                  id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> list[tuple[str, int]]:
    """At most ``toxic`` and ``clean`` labelled texts of the two classes, none over ``max_chars``, outside the held-out fold
    (crc32 of the id as text, modulo 5, is 0 there). They are those with the smallest id digest; both bounds
    serve the fit alone."""
    wanted = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
              .where("id IS NOT NULL AND y IN (0, 1)").where(~held_out(F.col("id"))).distinct()
              .withColumn("digest", F.xxhash64(F.col("id").cast("string"))))
    # twice the bound, as some have no row in docs or are too long
    bound = (clean, toxic)
    ids = [wanted.where(F.col("y") == y).orderBy("digest", "id").limit(2 * bound[y]) for y in (0, 1)]
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .where(F.length("text") <= max_chars)
             .join(F.broadcast(ids[0].union(ids[1])), "id"))
    # repeated rows are one, and the bounds hold before anything comes to the driver
    order = Window.partitionBy("y").orderBy("digest", "text")
    rows = (texts.select("y", "digest", "text").distinct().withColumn("nth", F.row_number().over(order))
            .where(F.col("nth") <= F.when(F.col("y") == 1, toxic).otherwise(clean))
            .where(F.col("nth") <= max(bound)).select("y", "text").collect())
    return [(r["text"], r["y"]) for r in rows]


def held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % 5 == 0


def score_texts(texts: Sequence[str | None], model: Model, memo: dict[str, float]) -> np.ndarray:
    """Probability that each whole text is toxic. ``memo`` keeps words' values between calls."""
    if len(memo) > _MEMO:
        memo.clear()
    words = [words_of(t or "") for t in texts]
    missing = sorted(set().union(*words).difference(memo))
    segments = [segments_of(w) for w in missing]
    distinct = sorted({s for found in segments for s in found})
    value = dict(zip(distinct, model.decide(distinct).tolist()))
    for w, found in zip(missing, segments):
        memo[w] = max((value[s] for s in found), default=model.floor)
    worst = [max(map(memo.__getitem__, found), default=model.floor) for found in words]
    return model.probability(np.array(worst, dtype=float))


def _scorer(spark, model: Model):
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo: dict[str, float] = {}  # a task's own: it goes with the task
        for s in texts:
            parts = [score_texts(s.iloc[i:i + 200].tolist(), shared.value, memo) for i in range(0, len(s), 200)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))
        memo.clear()
        released()

    return score


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts have no segment and get the lowest decision value's probability. Null ids are in no fold
    (held_out false). Repeated rows stay rows; an empty table gives an empty result; other columns are not read."""
    score = _scorer(docs.sparkSession, model)
    return (docs.select(F.col(id_col).alias("doc_id"), score(F.col(text_col)).alias("score"))
            .select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with all their columns."""
    return docs.where(_scorer(docs.sparkSession, model)(F.col(text_col)) < 0.5)
