"""Quality classifier from weak labels.

1. Overlapping heuristic labellers each vote good, bad or nothing on every
   document (``LABELLERS``). The votes of one document are one pattern; the
   corpus is summed to pattern counts (at most 3 ** 8 rows, whatever its
   size).
2. Expectation-maximisation over the pattern counts: a document is good or
   has one kind of fault, one kind per labeller, as faults rarely come
   together. It estimates the share of each kind and every labeller's
   accuracy on each (its chance to vote bad; no vote is no evidence), from
   the votes taken at face value, with two bounds that keep the kinds what
   they are: on good documents a labeller errs with at most ``MAX_FALSE``,
   on its own kind it is right with at least ``MIN_TRUE``. Each pattern gets
   the posterior of being good.
3. The posteriors of a bounded sample (``SAMPLE`` documents of each side, the
   first in a seeded hash order of their ids) train a hashed linear scorer:
   logistic regression over word shapes, shape pairs, repeats and short
   words, hashed to 2 ** 15 weights.
4. Every whole document is scored; those at ``KEEP_FROM`` or more are kept.

No given label is read. Letters are those of any script; the labeller of
function words, which knows four languages, abstains on text that is mostly in
other scripts. Word shapes are cut at 8 characters, word lengths at 63.
Defined cases: an id of several texts trains with the text of the smallest
hash, once; null and empty texts have no words:
every labeller that needs words abstains, the score is the scorer's on no
features; a null id is never a training row; repeated rows are scored row by
row; when all documents fall on one side (or there are none) the score is
the pattern's posterior; extra columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import FUNCTION_WORDS, drop, stage

SAMPLE = 2500              # training documents of each side
HASH_BITS = 15
KEEP_FROM = 0.5
MAX_FALSE = 0.02           # bound on a labeller's bad votes on good documents
MIN_TRUE = 0.7             # and its bad votes on its own kind of fault
MEMO = 400_000             # words a worker remembers

LABELLERS = ("repeats", "symbols", "capitals", "variety", "lines", "sentences", "word_length", "function_words")

_CLASS = np.zeros(256, np.uint8)            # byte classes: 1 lower, 2 upper, 3 symbol, 4 other letter
_CLASS[97:123] = 1
_CLASS[65:91] = 2
for _c in b"#$%&*+/<=>@[\\]^_`{|}~!":
    _CLASS[_c] = 3
_CLASS[0xC3:0xF5] = 4                       # first byte of a letter beyond ASCII ...
_CLASS[0xE2] = 0                            # ... but for punctuation and signs
_RUNS = re.compile(r"(.)\1+")


def _shape(word: str) -> str:
    """Letters as a / A, digits as 0, other characters kept; runs cut to one."""
    return _RUNS.sub(r"\1", "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word))[:8]


class Words(dict):
    """Word -> word hash, shape feature and flags, packed; filled as met."""

    def __missing__(self, word: str) -> int:
        low = word.lower().strip(".,;:!?")
        shape = zlib.crc32(_shape(word).encode()) & 0xFFFF
        known = low in FUNCTION_WORDS
        value = zlib.crc32(low.encode()) << 24 | shape << 8 | known << 7 | min(len(word), 63)
        if len(self) >= MEMO:
            self.clear()
        self[word] = value
        return value


class Document:
    """What labellers and features read of a text, in a few arrays."""

    def __init__(self, text: str, words: Words):
        found = text.split()
        self.n = len(found)
        packed = np.fromiter(map(words.__getitem__, found), np.int64, self.n)
        self.word = packed >> 24
        self.shape = (packed >> 8) & 0xFFFF
        self.known = (packed >> 7) & 1
        self.length = packed & 63
        self.repeat = self.word[1:] == self.word[:-1]
        self.text = text


def _vote(good: bool, bad: bool) -> int:
    """2 good, 0 bad, 1 nothing."""
    return 0 if bad else 2 if good else 1


def votes(d: Document) -> list[int]:
    """One vote per labeller; see ``LABELLERS``."""
    n = d.n
    if not n:
        return [1] * len(LABELLERS)
    _, lower, upper, symbol, other = (int(x) for x in np.bincount(_CLASS[np.frombuffer(d.text.encode(), np.uint8)], minlength=5))
    letters, latin, repeats = lower + upper + other, lower + upper >= other, float(d.repeat.mean()) if n > 1 else 0.0
    distinct = len(np.unique(d.word))
    lines = [x for x in d.text.split("\n") if x.strip()]
    repeated_lines = 1 - len(set(lines)) / len(lines)
    mean, known, stops = float(d.length.mean()), float(d.known.mean()), (d.text.count(".") + d.text.count("?")) / n
    return [
        _vote(n >= 5 and repeats < 0.05, repeats > 0.25),
        _vote(symbol / (letters + symbol + 1) < 0.005, symbol / (letters + symbol + 1) > 0.04),
        _vote(letters >= 10 and upper / letters < 0.15, letters >= 10 and upper / letters > 0.4),
        _vote(n >= 20 and distinct > 2.5 * math.sqrt(n), n >= 20 and distinct < 1.5 * math.sqrt(n)),
        _vote(len(lines) >= 3 and repeated_lines < 0.1, len(lines) >= 3 and repeated_lines > 0.5),
        _vote(n >= 8 and 0.02 <= stops <= 0.4, n >= 30 and (stops < 0.004 or stops > 0.8)),
        _vote(n >= 5 and 3.0 <= mean <= 9.5, n >= 5 and (mean < 2.0 or mean > 14.0)),
        _vote(latin and n >= 10 and known >= 0.08, latin and n >= 20 and known < 0.01),
    ]


def pattern_of(d: Document) -> int:
    code = 0
    for v in votes(d):
        code = code * 3 + v
    return code


def features(d: Document) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a document: indexes and square-rooted shares."""
    if not d.n:
        return np.zeros(0, np.int64), np.zeros(0)
    mask = (1 << HASH_BITS) - 1
    parts = [d.shape * 40503 + 17, (d.shape[:-1] * 31 + d.shape[1:]) * 40503 + 29,
             np.full(int(d.repeat.sum()), 12345), d.word[d.length <= 3] * 40503 + 43]
    ids = np.concatenate(parts) & mask
    index, count = np.unique(ids, return_counts=True)
    return index, np.sqrt(count / d.n)


@dataclass
class Model:
    good: float = 0.5                                   # share of good documents
    accuracy: np.ndarray | None = None                  # P(bad vote | kind): labeller x (good, kinds)
    posterior: dict[int, float] = field(default_factory=dict)
    weights: np.ndarray | None = None                   # hashed scorer; None: use the posterior
    bias: float = 0.0


def estimate(counts: dict[int, int], rounds: int = 300) -> Model:
    """EM over pattern counts; kind 0 is good, kind k + 1 the fault that
    labeller k looks for."""
    m = len(LABELLERS)
    codes = np.array(sorted(counts), np.int64)
    n = np.array([counts[int(c)] for c in codes], float)
    vote = np.stack([(codes // 3 ** (m - 1 - k)) % 3 for k in range(m)], 1)
    bad, cast = (vote == 0).astype(float), (vote != 1).astype(float)
    kind = np.column_stack([bad.sum(1) == 0, bad]).astype(float)
    kind /= kind.sum(1, keepdims=True)
    own = np.arange(m)
    accuracy = np.full((m, m + 1), 0.5)
    share = np.full(m + 1, 1 / (m + 1))
    for _ in range(rounds):
        weight = kind * n[:, None]
        share = (weight.sum(0) + 1e-3) / (weight.sum() + 1e-3 * (m + 1))
        new = (bad.T @ weight + 0.5) / (cast.T @ weight + 1.0)
        new[:, 0] = np.minimum(new[:, 0], MAX_FALSE)
        new[own, own + 1] = np.maximum(new[own, own + 1], MIN_TRUE)
        logit = np.log(share) + bad @ np.log(new) + (cast - bad) @ np.log(1 - new)
        kind = np.exp(logit - logit.max(1, keepdims=True))
        kind /= kind.sum(1, keepdims=True)
        done, accuracy = np.abs(new - accuracy).max() < 1e-9, new
        if done:
            break
    return Model(float(share[0]), accuracy, dict(zip(codes.tolist(), kind[:, 0].tolist(), strict=True)))


def train(rows, share: float, rounds: int = 400, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on (index, value, posterior) rows by accelerated
    gradient steps; rows are weighted to the corpus share of each side."""
    index = np.concatenate([r[0] for r in rows]).astype(np.int64)
    value = np.concatenate([r[1] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    y = np.array([r[2] for r in rows])
    side = y >= 0.5
    weight = np.where(side, share / max(side.mean(), 1e-9), (1 - share) / max(1 - side.mean(), 1e-9))
    weight = weight / weight.sum()
    w, bias = np.zeros(1 << HASH_BITS), 0.0
    vw, vb, step = w.copy(), 0.0, 2.0
    for t in range(rounds):
        z = np.bincount(row, weights=value * vw[index], minlength=len(rows)) + vb
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        grad = np.bincount(index, weights=value * g[row], minlength=len(w)) + ridge * vw
        nw, nb = vw - step * grad, vb - step * float(g.sum())
        k = t / (t + 3)
        vw, vb, w, bias = nw + k * (nw - w), nb + k * (nb - bias), nw, nb
    return w, bias


_WORDS = Words()


def _patterns(text: Column) -> Column:
    @F.pandas_udf("int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([pattern_of(Document(t, _WORDS)) for t in batch], dtype="int32")
    return run(F.coalesce(text, F.lit("")))


def _features(text: Column) -> Column:
    @F.pandas_udf("i array<int>, v array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([features(Document(t, _WORDS)) for t in batch], columns=["i", "v"])
    return run(F.coalesce(text, F.lit("")))


def fit(docs: DataFrame, *, id_col="doc_id", text_col="text", sample=SAMPLE) -> Model:
    """Votes of all documents, EM, and the scorer's fit on the sample."""
    spark, text = docs.sparkSession, F.coalesce(F.col(text_col), F.lit(""))
    voted, voted_path = stage(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h"),
                                          _patterns(F.col(text_col)).alias("pattern")), "quality-votes")
    model = estimate({r["pattern"]: r["n"] for r in voted.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()} or {0: 0})
    bad = [p for p, good in model.posterior.items() if good < 0.5]
    if not bad or len(bad) == len(model.posterior):
        drop(spark, voted_path)
        return model
    is_bad = F.col("pattern").isin(bad)
    known = (voted.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct("h", "pattern")).alias("k"))
             .select("doc_id", "k.h", "k.pattern"))
    order = F.xxhash64("doc_id", F.lit(5))
    picked = (known.filter(is_bad).orderBy(order, "doc_id").limit(sample)
              .unionByName(known.filter(~is_bad).orderBy(order, "doc_id").limit(sample)))
    # one row per picked id, however many rows repeat it: 2 * sample rows at most
    texts = (docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
             .join(F.broadcast(picked), ["doc_id", "h"]).groupBy("doc_id", "pattern").agg(F.min("text").alias("text")))
    rows = texts.select("doc_id", "pattern", _features(F.col("text")).alias("f")).select("doc_id", "pattern", "f.*").collect()
    drop(spark, voted_path)
    rows.sort(key=lambda r: (r["doc_id"], len(r["i"])))
    model.weights, model.bias = train(
        [(np.array(r["i"], np.int64), np.array(r["v"], float), model.posterior[r["pattern"]]) for r in rows], model.good)
    return model


def score(spark: SparkSession, text: Column, model: Model) -> Column:
    """The scorer's probability that a text is good."""
    shared = spark.sparkContext.broadcast(model)          # 2 ** 15 weights and the patterns

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value

        def one(text: str) -> float:
            d = Document(text, _WORDS)
            if m.weights is None:
                return m.posterior.get(pattern_of(d), m.good)
            index, value = features(d)
            return 1 / (1 + math.exp(-max(-500.0, min(500.0, float(value @ m.weights[index]) + m.bias))))

        for batch in batches:
            yield pd.Series([one(t) for t in batch], dtype="float64")

    return run(F.coalesce(text, F.lit("")))
