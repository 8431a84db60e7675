"""Toxicity by maximum-scoring segments of token log-odds.

Fit, on a bounded sample of labelled rows (``TRAIN_PER_CLASS`` of each class,
the first in a seeded hash order of their ids): two thirds give every word,
and every word's first six, five and four letters, its log-odds between toxic
and clean text with an informative Dirichlet prior (pooled frequencies times
a prior weight). A feature counts when the z-score of its log-odds over
documents, which repeats inside one document don't raise, passes ``MIN_Z``;
it then scores its log-odds over words less one standard error. All other
words score ``-DRIFT``, so that the expected score of clean text is negative.

Score: Ruzzo and Tompa's linear-time scan finds all maximal-scoring segments
of a whole text. The best score of n clean words has an extreme-value
distribution, P(S >= x) = 1 - exp(-K n exp(-lambda x)); lambda solves
sum p_s exp(lambda s) = 1 over the clean score distribution, K is fitted on
the sample's last third. Segments expected less than ``MAX_EXPECTED`` times
in a clean text of that length are the toxic passages; their evidence
(lambda S - ln K n), best and summed, is calibrated to a probability by a
logistic fit on that last third, weighted to the class shares of all
training labels.

Label, lang, source and id are no inputs of a score. Defined cases: null and
empty texts have no words and get the score of a text without evidence; a
label row with a null id or label is no training row; several labels of one
id count as toxic when one does; without training rows of both classes the
score is the share of toxic labels (0 without labels); repeated rows are
scored row by row; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TRAIN_PER_CLASS = 3000     # labelled rows read for the fit, per class
PRIOR_DOCS = 100.0         # weight of the Dirichlet prior over document counts
PRIOR_WORDS = 1000.0       # and over word counts
MIN_Z = 4.0
MIN_COUNT = 5
DRIFT = 0.3
MAX_EXPECTED = 0.01
MEMO = 300_000             # words whose score a worker remembers

words_of = re.compile(r"[^\W_]+").findall


def features(word: str) -> tuple[str, ...]:
    """A word and its first six, five and four letters (marked by length)."""
    return (word, "6:" + word[:6], "5:" + word[:5], "4:" + word[:4]) if len(word) > 4 else (word,)


@dataclass
class Model:
    scores: dict[str, float] = field(default_factory=dict)
    drift: float = DRIFT
    lam: float = 1.0
    k: float = 1.0
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)   # bias, best, summed evidence


class _Memo(dict):
    """Word -> score, filled as words are met; forgets all when full."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        get = self.model.scores.get
        score = next((s for f in features(word) if (s := get(f)) is not None), -self.model.drift)
        if len(self) >= MEMO:
            self.clear()
        self[word] = score
        return score


def maximal_segments(scores) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, score) of a score sequence,
    in one pass (Ruzzo and Tompa). Each candidate keeps the cumulative sums
    before and after it and, found once, the last candidate that starts lower."""
    found: list[list] = []                # [first, end, sum before, sum after, link to a lower start]
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        seg = [i, i + 1, before, total, -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= seg[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= seg[3]:
                seg[4] = j
                found.append(seg)
                break
            seg[0], seg[2] = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, after - before) for a, b, before, after, _ in found]


def _evidence(model: Model, n: int, score: float) -> float:
    """Minus the log of the expected number of such segments in n clean words."""
    return model.lam * score - math.log(model.k * max(n, 1))


def _segments(memo: _Memo, text: str) -> tuple[int, list[tuple[int, int, float]]]:
    words = words_of(text.lower())
    scores = list(map(memo.__getitem__, words))
    if not scores or max(scores) <= 0:
        return len(scores), []
    return len(scores), maximal_segments(_once(words, scores, memo.model.drift))


def _once(words: list[str], scores: list[float], drift: float) -> list[float]:
    """Scores in which a word right after itself is no new evidence."""
    return [s if s <= 0 or w != last else -drift for w, last, s in zip(words, ["", *words], scores, strict=False)]


def _inputs(model: Model, n: int, segments) -> tuple[float, float, list]:
    """Best and summed evidence, and the significant segments."""
    best = max((_evidence(model, n, s) for _, _, s in segments), default=0.0)
    passages = [(a, b, e) for a, b, s in segments if (e := _evidence(model, n, s)) > -math.log(MAX_EXPECTED)]
    return max(best, 0.0), math.log1p(sum(e for _, _, e in passages)), passages


def _probability(model: Model, best: float, summed: float) -> float:
    bias, w1, w2 = model.weights
    return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, bias + w1 * min(best, 50.0) + w2 * summed))))


def _kept(shared, keep: dict) -> _Memo:
    if keep.get("of") is not shared.value:
        keep.update(of=shared.value, memo=_Memo(shared.value))
    return keep["memo"]


_KEPT: dict = {}


def score(spark: SparkSession, text: Column, model: Model) -> Column:
    """struct(score, n_words, n_passages, best) of a text."""
    shared = spark.sparkContext.broadcast(model)    # bounded by the training sample

    @F.pandas_udf("score double, n_words long, n_passages int, best double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memo = _kept(shared, _KEPT)
        for batch in batches:
            rows = []
            for t in batch:
                n, segments = _segments(memo, t)
                best, summed, passages = _inputs(memo.model, n, segments)
                rows.append((_probability(memo.model, best, summed), n, len(passages), best))
            yield pd.DataFrame(rows, columns=["score", "n_words", "n_passages", "best"])

    return scored(F.coalesce(text, F.lit("")))


def passages(spark: SparkSession, text: Column, model: Model) -> Column:
    """array<struct(start, end, evidence)>: significant passages of a text,
    as offsets of code points."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("array<struct<start:int,end:int,evidence:double>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = _kept(shared, _KEPT)
        for batch in batches:
            out = []
            for t in batch:
                spans = [m.span() for m in re.finditer(r"[^\W_]+", t)]
                words = [t[a:b].lower() for a, b in spans]
                scores = _once(words, [memo[w] for w in words], memo.model.drift)
                _, _, kept = _inputs(memo.model, len(spans), maximal_segments(scores))
                out.append([{"start": spans[a][0], "end": spans[b - 1][1], "evidence": e} for a, b, e in kept])
            yield pd.Series(out, dtype=object)

    return found(F.coalesce(text, F.lit("")))


def training_rows(labels: DataFrame, *, id_col="doc_id", label_col="toxic", hold_out: Column | None = None) -> DataFrame:
    """(doc_id, y): one row per labelled id outside the held-out part."""
    rows = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).dropna()
    if hold_out is not None:
        rows = rows.filter(~hold_out)
    return rows.groupBy("doc_id").agg(F.max("y").alias("y"))


def fit(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", train_per_class=TRAIN_PER_CLASS) -> Model:
    """Fit on the sample; ``labels`` is the output of ``training_rows``."""
    spark = docs.sparkSession
    order = F.xxhash64("doc_id", F.lit(7))
    share = {r["y"]: r["n"] for r in labels.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic = sum(n for y, n in share.items() if y)
    total = sum(share.values())
    if not toxic or toxic == total:
        p = min(max(toxic / total if total else 0.0, 1e-9), 1 - 1e-9)
        return Model(weights=(math.log(p / (1 - p)), 0.0, 0.0))
    sample = None
    for one in (labels.filter("y > 0"), labels.filter("y <= 0")):
        part = one.orderBy(order, "doc_id").limit(train_per_class)
        sample = part if sample is None else sample.unionByName(part)
    sample = sample.select(F.col("doc_id").alias("_id"), (F.col("y") > 0).cast("int").alias("_y"),
                           (F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(3)) == 0).alias("_last"))
    texts = (docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
             .join(F.broadcast(sample), "_id")
             # one row per picked id (of several texts the one of the smallest hash),
             # however many rows repeat it: 2 * train_per_class rows at most
             .groupBy("_id", "_y", "_last").agg(F.min(F.struct(F.xxhash64("_text").alias("h"), "_text")).alias("t"))
             .select("_id", "_y", "_last", "t._text"))

    def count(batches):
        counts: dict[str, list[int]] = {}
        n = [0, 0, 0, 0]
        for batch in batches:
            for t, y in zip(batch["_text"], batch["_y"], strict=True):
                words = words_of(t.lower())
                n[y] += 1
                n[2 + y] += len(words)
                for f, c in Counter(f for w in words for f in features(w)).items():
                    row = counts.setdefault(f, [0, 0, 0, 0])
                    row[y] += 1
                    row[2 + y] += c
        yield pd.DataFrame([("", *n), *((f, *row) for f, row in counts.items())],
                           columns=["f", "d0", "d1", "t0", "t1"])

    counted = (texts.filter(~F.col("_last")).mapInPandas(count, "f string, d0 long, d1 long, t0 long, t1 long")
               .groupBy("f").agg(*[F.sum(c).alias(c) for c in ("d0", "d1", "t0", "t1")])
               .filter((F.col("f") == "") | (F.col("d0") + F.col("d1") >= MIN_COUNT)).toPandas())
    model = Model(scores=_log_odds(counted))
    model.lam = _lambda(counted, model)

    rows = texts.filter("_last").select("_y", _best(spark, F.col("_text"), model).alias("b")).select("_y", "b.*").toPandas()
    clean = rows[rows["_y"] == 0]
    if len(clean):
        model.k = float(len(clean) / max(1e-9, np.sum(clean["n"].clip(lower=1) * np.exp(-model.lam * clean["s"]))))
    model.weights = _calibrate(rows, model, toxic / total)
    return model


def _best(spark: SparkSession, text: Column, model: Model) -> Column:
    """struct(n, s, all): words, best segment score, all segment scores."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("n long, s double, all array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memo = _Memo(shared.value)
        for batch in batches:
            rows = []
            for t in batch:
                n, segments = _segments(memo, t)
                each = [s for _, _, s in segments]
                rows.append((n, max(each, default=0.0), each))
            yield pd.DataFrame(rows, columns=["n", "s", "all"])

    return run(text)


def _odds(y0, y1, n0, n1, prior):
    """Log-odds ratio and its standard error under a Dirichlet prior of the
    pooled frequencies."""
    a = prior * (y0 + y1) / max(1.0, n0 + n1)
    odds = lambda y, n: np.log(y + a) - np.log(np.maximum(n + prior - y - a, 0.5))
    return odds(y1, n1) - odds(y0, n0), np.sqrt(1 / (y1 + a) + 1 / (y0 + a))


def _log_odds(counted: pd.DataFrame) -> dict[str, float]:
    n = counted[counted["f"] == ""]
    c = counted[counted["f"] != ""]
    if not len(c):
        return {}
    of = lambda k: c[k].to_numpy(float)
    by_doc, error = _odds(of("d0"), of("d1"), float(n["d0"].sum()), float(n["d1"].sum()), PRIOR_DOCS)
    by_word, _ = _odds(of("t0"), of("t1"), float(n["t0"].sum()), float(n["t1"].sum()), PRIOR_WORDS)
    sure = np.abs(by_word) - error
    keep = (np.abs(by_doc) >= MIN_Z * error) & (sure > 0) & (np.sign(by_doc) == np.sign(by_word))
    return dict(zip(c["f"][keep], (np.sign(by_word) * sure)[keep].tolist(), strict=True))


def _lambda(counted: pd.DataFrame, model: Model) -> float:
    """Root of sum p_s exp(lambda s) = 1 over the clean score distribution,
    with the prior's share for words that clean documents never hold."""
    c = counted[(counted["f"] != "") & ~counted["f"].str.contains(":", regex=False)]
    t0, t1 = c["t0"].to_numpy(float), c["t1"].to_numpy(float)
    p = t0 + PRIOR_WORDS * (t0 + t1) / max(1.0, float(t0.sum() + t1.sum()))
    p = p / max(p.sum(), 1e-9)
    memo = _Memo(model)
    s = np.array([memo[w] for w in c["f"]])
    if not len(s) or s.max() <= 0:
        return 1.0
    f = lambda x: float(np.sum(p * np.exp(np.minimum(x * s, 700.0)))) - 1.0
    if float(np.sum(p * s)) >= 0:
        return 0.1
    low, high = 0.0, 1.0
    while f(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return max(high, 1e-3)


def _calibrate(rows: pd.DataFrame, model: Model, toxic_share: float) -> tuple[float, float, float]:
    """Weighted logistic fit of (best, summed) evidence, by Newton steps."""
    y = rows["_y"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        p = min(max(toxic_share, 1e-6), 1 - 1e-6)
        return math.log(p / (1 - p)), 0.5, 0.5
    x = np.array([(1.0, min(b, 50.0), s) for n, each in zip(rows["n"], rows["all"], strict=True)
                  for b, s, _ in [_inputs(model, int(n), [(0, 0, v) for v in each])]])
    weight = np.where(y > 0, toxic_share / y.mean(), (1 - toxic_share) / (1 - y.mean()))
    w = _logistic(x, y, weight)
    for kept in ([0, 2], [0, 1]):       # evidence must not lower the probability
        if min(w[1:]) < 0:
            w = np.zeros(3)
            w[kept] = _logistic(x[:, kept], y, weight)
    return float(w[0]), max(0.0, float(w[1])), max(0.0, float(w[2]))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    ridge = np.diag([0.01] + [0.1] * (len(w) - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hess, x.T @ (weight * (p - y)) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
