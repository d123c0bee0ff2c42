"""Toxic passages by maximum-scoring segment search.

Token scores are log-odds between toxic and clean labelled documents under
Dirichlet priors: a word starts from what its prefixes say (three letters up
to eight, each the prior of the next), so unseen forms of a known stem score
too. In every whole text a linear scan (all maximal scoring segments) finds
the passages in which toxic tokens crowd. A passage of score S among N tokens
is expected K * N * exp(-lambda * S) times by chance, with lambda and K from
the scores of clean documents; the passages' significances are summed and a
logistic curve, fitted on rows that the token scores have not seen, turns the
sum into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.io import bounded_batches, sampled, settle

_WORD = re.compile(r"\w+")
SHORTEST, LONGEST = 3, 8


def tokens_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _features(word: str) -> list[str]:
    """Prefixes of a word from short to long, then the word itself."""
    return [word[:k] for k in range(SHORTEST, min(LONGEST, len(word) - 1) + 1)] + [word + "$"]


@dataclass(frozen=True)
class Model:
    odds: dict           # feature -> log-odds
    drift: float         # taken off each token, so that chance passages stay short
    rate: float          # lambda of the extreme-value law
    scale: float         # ln K
    slope: float
    offset: float

    def word(self, word: str) -> float:
        """Score of a word: of the longest known feature."""
        for f in reversed(_features(word)):
            found = self.odds.get(f)
            if found is not None:
                return found - self.drift
        return -self.drift


def segments(scores) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a score array.

    Linear: each positive run is pushed once and merged at most once.
    """
    import numpy as np

    up = scores > 0
    if not up.any():
        return []
    edge = np.flatnonzero(np.diff(np.concatenate(([False], up, [False])).astype(np.int8)))
    total = np.concatenate(([0.0], np.cumsum(scores)))
    stack: list[list] = []  # start, end, total before, total after, nearest earlier one with a lower total before
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        now = [a, b, float(total[a]), float(total[b]), -1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= now[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= now[3]:
                now[4] = j
                stack.append(now)
                break
            now = [stack[j][0], now[1], stack[j][2], now[3], -1]
            del stack[j:]
    return [(a, b, after - before) for a, b, before, after, _ in stack]


def significance(model: Model, found, n: int) -> float:
    """ln of the summed 1 / E of the passages among n tokens."""
    floor = -model.scale - math.log(max(n, 1))
    if not found:
        return floor
    each = [model.rate * s for _, _, s in found]
    top = max(each)
    return floor + top + math.log(sum(math.exp(e - top) for e in each))


def probability(model: Model, x: float) -> float:
    z = max(-500.0, min(500.0, model.slope * x + model.offset))
    return 1 / (1 + math.exp(-z))


class Scorer:
    """Scores of texts with a per-task cache of word scores."""

    def __init__(self, model: Model, most: int = 1_000_000):
        self.model, self.known, self.most = model, {}, most

    def tokens(self, words: list[str]):
        import numpy as np

        known = self.known
        if len(known) > self.most:
            known.clear()
        out = [known.get(w) for w in words]
        if None in out:
            for k, s in enumerate(out):
                if s is None:
                    w = words[k]
                    out[k] = known[w] = known[w] if w in known else self.model.word(w)
        return np.array(out, float)

    def text(self, text: str | None):
        """(probability, passages as (start, end, score) of word places, significance)."""
        words = tokens_of(text)
        found = segments(self.tokens(words)) if words else []
        x = significance(self.model, found, len(words))
        return probability(self.model, x), found, x


def _labelled(docs: DataFrame, labels: DataFrame, held_out, rows: int) -> DataFrame:
    """The labelled rows to learn from: ``rows`` at most, by the hash of their id."""
    truth = labels.where("doc_id is not null and toxic is not null").where(~held_out).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = sampled(settle(truth, "toxic-labels"), ["doc_id"], rows).withColumn("deal", F.xxhash64("doc_id"))
    once = docs.select("doc_id", "text").where("doc_id is not null")
    return once.join(F.broadcast(chosen), "doc_id")  # bounded by ``rows``


def learn_odds(sample: DataFrame, prior: float, least: int, drift: float) -> dict:
    """Log-odds of features by document counts, each with its shorter prefix as Dirichlet prior."""

    def count(batches):
        seen, toxic = Counter(), Counter()
        docs, bad = 0, 0
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                own = {f for w in set(tokens_of(text)) for f in _features(w)}
                seen.update(own)
                docs += 1
                if label:
                    toxic.update(own)
                    bad += 1
            if len(seen) > 2_000_000:
                yield pd.DataFrame({"feature": list(seen), "n": list(seen.values()), "t": [toxic[f] for f in seen]})
                seen, toxic = Counter(), Counter()
        yield pd.DataFrame({"feature": ["", *seen], "n": [docs, *seen.values()], "t": [bad, *(toxic[f] for f in seen)]})

    counted = (sample.mapInPandas(count, "feature string, n long, t long").groupBy("feature")
               .agg(F.sum("n").alias("n"), F.sum("t").alias("t")).where((F.col("n") >= least) | (F.col("feature") == "")).toPandas())
    rows = {f: (n, t) for f, n, t in zip(counted["feature"], counted["n"], counted["t"], strict=True)}
    docs, bad = rows.pop("", (0, 0))
    if not 0 < bad < docs:
        return {}
    base = bad / docs
    share, odds = {}, {}
    for feature in sorted(rows, key=lambda f: (f.endswith("$"), len(f), f)):
        n, t = rows[feature]
        word = feature.removesuffix("$")
        cuts = range(min(LONGEST, len(word) - 1), SHORTEST - 1, -1)
        mean = next((share[word[:k]] for k in cuts if word[:k] != feature and word[:k] in share), base)
        share[feature] = p = (t + prior * mean) / (n + prior)
        odds[feature] = math.log(p / (1 - p)) - math.log(base / (1 - base))
    return odds


def _rate(scores, weights) -> float:
    """lambda > 0 with sum(weight * exp(lambda * score)) = 1; the mean score is negative."""
    import numpy as np

    low, high = 1e-6, 20.0
    for _ in range(80):
        mid = (low + high) / 2
        if (weights * np.exp(np.minimum(mid * scores, 50))).sum() > 1:
            high = mid
        else:
            low = mid
    return low


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 16_000, prior: float = 4.0, least: int = 4, drift: float = 1.0) -> Model:
    """Learn from the labelled rows whose crc32(doc_id as text) mod 4 is not 2.

    Of at most ``sample_rows`` of them those with remainder 1 calibrate, the
    others give the token scores. Labels that name one class only give a model
    without tokens: every score is the base rate's.
    """
    import numpy as np

    bounded_batches(docs.sparkSession)
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    sample = settle(_labelled(docs, labels, fold == 2, sample_rows).withColumn("fold", fold), "toxicity-sample")
    odds = learn_odds(sample.where("fold <> 1"), prior, least, drift)
    plain = Model(odds, drift, 1.0, 0.0, 1.0, 0.0)

    def calibration(batches):
        scorer = Scorer(plain)
        for batch in batches:
            rows = []
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                words = tokens_of(text)
                scores = scorer.tokens(words)
                values, counts = np.unique(np.round(scores, 1), return_counts=True)
                rows.append((int(label), len(words), [s for *_, s in segments(scores)], values.tolist(), counts.tolist()))
            yield pd.DataFrame(rows, columns=["toxic", "n", "found", "values", "counts"])

    held = (sample.where("fold = 1").mapInPandas(calibration, "toxic int, n long, found array<double>, values array<double>, counts array<long>").toPandas())
    y = held["toxic"].to_numpy(float)
    if not len(held) or not 0 < y.sum() < len(y):
        share = min(max(y.mean() if len(y) else 0.5, 0.01), 0.99)
        return Model(odds, drift, 1.0, 0.0, 0.0, math.log(share / (1 - share)))
    chance = Counter()
    for label, values, counts in zip(held["toxic"], held["values"], held["counts"], strict=True):
        if not label:
            for v, c in zip(values, counts, strict=True):
                chance[v] += c
    scores = np.array(list(chance), float)
    weights = np.array(list(chance.values()), float)
    rate = _rate(scores, weights / max(1.0, weights.sum()))
    best = np.array([max(f, default=0.0) if f is not None else 0.0 for f in held["found"]])
    n = np.maximum(held["n"].to_numpy(float), 1)
    # Gumbel mode of the best clean passage: lambda * S - ln N has mean ln K + 0.5772
    clean = y == 0
    scale = float(np.mean((rate * best - np.log(n))[clean]) - 0.5772)
    law = Model(odds, drift, rate, scale, 1.0, 0.0)
    x = np.array([significance(law, [(0, 0, s) for s in f], int(m)) for f, m in zip(held["found"], held["n"], strict=True)])
    a, b = 1.0, 0.0
    for _ in range(200):  # Newton steps of a lightly penalised logistic curve
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - y) * x).sum() + 0.01 * a, (p - y).sum()])
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-7:
            break
    return Model(odds, drift, rate, scale, max(float(a), 1e-3), float(b))


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; others ignored): doc_id,
    score (0 to 1), predicted, and ``passages``: the significant ones as
    (first_word, last_word, score).

    A null or empty text has no tokens and scores as one without passages.
    Repeated rows score alike; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    kept = "array<struct<first_word:long,last_word:long,score:double>>"

    @F.pandas_udf(f"score double, passages {kept}")
    def judged(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for texts in parts:
            rows = []
            for text in texts:
                p, found, _ = scorer.text(text)
                strong = [(a, b - 1, s) for a, b, s in found if model.rate * s > 3]
                rows.append((p, [{"first_word": a, "last_word": b, "score": s} for a, b, s in strong]))
            yield pd.DataFrame(rows, columns=["score", "passages"])

    out = docs.select("doc_id", "text").withColumn("judged", judged("text"))
    return out.select("doc_id", "judged.*").withColumn("predicted", (F.col("score") >= threshold).cast("int"))
