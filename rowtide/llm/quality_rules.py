"""Quality rules: a learned decision list over whole-text statistics.

``with_statistics`` counts, for every whole text, words, symbols, repeated
lines and repeated word windows. ``learn`` fits rejecting rules on labelled
statistics by sequential covering: a rule is grown condition by condition
(threshold on one statistic, best information gain) on two thirds of the
sample, pruned from its end on the other third, kept only if it is precise
there, and what it covers is set aside before the next rule is grown.
``verdict`` turns the list into one ordered Spark conditional, so applying it
is plain column arithmetic.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.io import bounded_batches, sampled, settle
from rowtide.llm.text import SPACES, utf8

#: fixed values of the contract
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEAT_PERCENT = 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_exclaim")

#: the statistics that rules may test: name -> (numerator, denominator)
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
    "upper_share": ("n_upper", "n_words"),
    "exclaim_per_word": ("n_exclaim", "n_words"),
}


def repeat_words(words: list) -> tuple[int, int]:
    """(words in a window of five that stands twice or more, distinct words)."""
    import numpy as np

    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    n, m = len(words), len(known)
    if n < WINDOW + 1 or m == n:
        return 0, m
    if m < 6000:  # five ids fit into one integer
        key = ids[:n - 4] * m + ids[1:n - 3]
        for k in (2, 3, 4):
            key = key * m + ids[k:n - 4 + k]
    else:
        pair = np.unique(ids[:-1] * m + ids[1:], return_inverse=True)[1]
        four = np.unique(pair[:-2] * n + pair[2:], return_inverse=True)[1]
        key = four[:-1] * m + ids[4:]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(key) + 1, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + WINDOW, -1)
    return int((np.cumsum(covered) > 0).sum()), m


def statistics_of(text: str | None) -> tuple:
    """The counts of one text, in the order of ``COUNTS``; null has no words."""
    text = text or ""
    words = utf8(text).split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    repeated, distinct = repeat_words(words)
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeated, len(lines), distinct, sum(map(bytes.isupper, words)), text.count("!"))


def with_statistics(docs: DataFrame, name: str = "statistics") -> DataFrame:
    """The frame with a struct column of the counts of ``text``."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def statistics(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics_of(t) for t in texts], columns=list(COUNTS)).astype("int64")

    return docs.withColumn(name, statistics("text"))


@dataclass(frozen=True)
class Condition:
    ratio: str
    above: bool
    threshold: float

    def column(self, prefix: str) -> Column:
        top, bottom = RATIOS[self.ratio]
        value = F.col(prefix + top).cast("double") / F.greatest(F.col(prefix + bottom), F.lit(1)).cast("double")
        return value >= self.threshold if self.above else value <= self.threshold

    def covers(self, x):
        value = x[self.ratio]
        return value >= self.threshold if self.above else value <= self.threshold


def _covers(rule, x):
    import numpy as np

    hit = np.ones(len(next(iter(x.values()))), bool)
    for c in rule:
        hit &= c.covers(x)
    return hit


def _grow(x, y, most_conditions: int):
    """Conditions with the best first-order information gain, until no keeper is covered."""
    import numpy as np

    rule, live = [], np.ones(len(y), bool)
    while len(rule) < most_conditions and (live & ~y).any():
        p0, n0 = (live & y).sum(), (live & ~y).sum()
        base, best = np.log2(p0 / (p0 + n0)), (1e-9, None)
        for name in RATIOS:
            values = x[name]
            for t in np.unique(np.quantile(values[live & y], np.linspace(0, 1, 33), method="nearest")):
                for above in (True, False):
                    hit = live & (values >= t if above else values <= t)
                    p = (hit & y).sum()
                    if p:
                        gain = p * (np.log2(p / hit.sum()) - base)
                        if gain > best[0]:
                            best = (gain, Condition(name, above, float(t)))
        if best[1] is None:
            break
        rule.append(best[1])
        live &= best[1].covers(x)
    return rule


def learn(sample: pd.DataFrame, least_precision: float = 0.97, least_covered: int = 4, most_rules: int = 12, most_conditions: int = 4) -> list[list[Condition]]:
    """Rejecting rules from rows of ``COUNTS`` and ``bad`` (0 or 1).

    Rows are dealt to growing and pruning by their place (every third prunes),
    so the same sample gives the same rules.
    """
    import numpy as np

    x = {r: sample[a].to_numpy(float) / np.maximum(sample[b].to_numpy(float), 1) for r, (a, b) in RATIOS.items()}
    y, prunes = sample["bad"].to_numpy(bool), np.arange(len(sample)) % 3 == 2
    rules, left = [], np.ones(len(sample), bool)
    while len(rules) < most_rules:
        grow, prune = left & ~prunes, left & prunes
        if not (y & grow).any():
            break
        rule = _grow({k: v[grow] for k, v in x.items()}, y[grow], most_conditions)
        best = (-2.0, None)
        held = {k: v[prune] for k, v in x.items()}
        for k in range(1, len(rule) + 1):
            hit = _covers(rule[:k], held)
            p, n = (hit & y[prune]).sum(), (hit & ~y[prune]).sum()
            worth = (p - n) / max(1, p + n)
            if worth > best[0]:
                best = (worth, rule[:k])
        if best[1] is None:
            break
        hit = _covers(best[1], x) & left
        p, n = (hit & y).sum(), (hit & ~y).sum()
        out = prune & hit
        if p < least_covered or p < least_precision * (p + n) or (y & out).sum() < least_precision * out.sum():
            break
        rules.append(best[1])
        left &= ~hit
    return rules


def verdict(rules: list[list[Condition]], prefix: str = "") -> Column:
    """The ordered conditional: true keeps, the first rule that fires rejects."""
    out = None
    for rule in rules:
        fires = rule[0].column(prefix)
        for c in rule[1:]:
            fires = fires & c.column(prefix)
        out = F.when(fires, False) if out is None else out.when(fires, False)
    return F.lit(True) if out is None else out.otherwise(True)


def base_failed(prefix: str = "") -> Column:
    words = F.col(prefix + "n_words")
    return (words < LEAST_WORDS) | (100 * F.col(prefix + "n_repeat_words") > MOST_REPEAT_PERCENT * words)


def fit(scored: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> list[list[Condition]]:
    """Learn from at most ``sample_rows`` labelled rows that pass the base, chosen by
    a hash below a threshold that follows from their number, so about that many rows and
    no more reach the driver at any input size. ``scored`` has doc_id and the
    counts; ``labels`` has doc_id and quality (1 good, 0 bad, null unlabelled;
    a doc_id that has both counts as bad)."""
    truth = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = settle(scored.where(~base_failed()).join(truth, "doc_id").select(
        "doc_id", *COUNTS, F.when(F.col("quality") == 0, 1).otherwise(0).alias("bad")), "quality-known")
    sample = sampled(known, ["doc_id", *COUNTS], sample_rows).toPandas()
    return learn(sample.sort_values(["doc_id", *COUNTS])[[*COUNTS, "bad"]].reset_index(drop=True)) if len(sample) else []


def judge(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; others ignored): doc_id, the
    counts, base_failed and kept.

    A null text counts as one without words and so fails the base. Repeated
    rows get the same verdict. Without labels no rule is learned and ``kept``
    is the base's verdict. An empty table gives an empty result.
    """
    counted = settle(with_statistics(docs.select("doc_id", "text")).select("doc_id", "statistics.*"), "quality-counts")
    rules = fit(counted, labels, sample_rows)
    return counted.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & verdict(rules))


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> DataFrame:
    """The rows of ``docs`` (all columns) that base and rules keep."""
    counts = settle(with_statistics(docs.select("doc_id", "text")).select("doc_id", "statistics.*"), "quality-counts")
    rules = fit(counts, labels, sample_rows)
    own = "__rowtide_statistics"
    good = with_statistics(docs, own)
    return good.where(~base_failed(own + ".") & verdict(rules, own + ".")).drop(own)
