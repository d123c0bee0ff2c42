"""Benchmark decontamination with a BM25 index and block-max WAND.

The test items are indexed: for each term the items it stands in with its
BM25 impact, as a share of the item's score against itself, in blocks of
items with the largest impact of each block. Every passage of every document
is a query (passages are twice as long as the longest item and overlap by
half, so each copy of an item lies whole in one). A passage is dropped if the
sum of its terms' largest impacts can't reach the threshold; then blocks by
the sum of their largest; only in what is left are items scored, and all that
reach the threshold are retrieved, however many. A retrieved pair counts as a
leak if both question and answer of the item are found word by word in the
passage's neighbourhood (or nearly the whole item is, with another answer).

Words of a batch of texts are found together: code points are folded by a table,
words become 64-bit numbers by prefix sums, and a bit table and a binary search tell
the index's terms. Word lists are made only for texts in which a pair was retrieved.
Index shards are built in tasks and written to the shared folder; a task that
scans loads the shards of its pass, at most ``SHARDS_A_PASS``.
"""

from __future__ import annotations

import math
import pickle
import re
import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.io import bounded_batches, filesystem, make_folder, scratch, settle
from rowtide.llm.text import _process_cache

LEAK = "array<struct<item_id:long,score:double,question_overlap:double,answer_overlap:double>>"
SHARDS_A_PASS = 4
#: code points that are folded at once, and the bits of the term filter
PIECE, FILTER_BITS = 1 << 20, 20


def _fold_table():
    """Code points below 2^16 in lower case; 0 for those that are no part of a word."""
    import numpy as np

    def build():
        word, lower = re.compile(r"\w"), [chr(c).lower() for c in range(1 << 16)]
        return np.array([ord(x) if len(x) == 1 and word.match(chr(c)) else c if word.match(chr(c)) else 0 for c, x in enumerate(lower)], np.uint32)

    cache = _process_cache()
    if "fold" not in cache:
        cache["fold"] = build()
    return cache["fold"]


def folded(text: str):
    """The code points of a text in lower case, 0 between words."""
    import numpy as np

    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    high = points >= 1 << 16
    out = _fold_table()[np.where(high, 0, points)]
    if high.any():
        rare, where = np.unique(points[high], return_inverse=True)
        out[high] = np.array([ord(c.lower()) if re.match(r"\w", c) and len(c.lower()) == 1 else 0 for c in map(chr, rare.tolist())], np.uint32)[where]
    return out


def words_of(text: str | None) -> list[str]:
    return [w for w in folded(text or "").tobytes().decode("utf-32-le", "surrogatepass").split("\0") if w]


def _powers():
    """Powers of an odd number modulo 2^64, and of its inverse."""
    import numpy as np

    cache = _process_cache()
    if "powers" not in cache:
        base = 0x9E3779B97F4A7C15
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(PIECE + 1, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        cache["powers"] = both
    return cache["powers"]


def word_numbers(points):
    """(a number for each word, where words begin) of at most ``PIECE`` folded code points."""
    import numpy as np

    power, inverse = _powers()
    inside = np.zeros(len(points) + 2, np.int8)
    inside[1:-1] = points > 0
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(points.astype(np.uint64) * power[:len(points)], out=sums[1:])
    return (sums[ends] - sums[starts]) * inverse[starts], starts


def _pieces(texts):
    """Texts as folded arrays of bounded size: (array, [(text, where it begins)])."""
    import numpy as np

    batch, spans, size = [], [], 0
    gap = np.zeros(1, np.uint32)
    for n, text in enumerate(texts):
        points = folded(text or "")
        while True:
            cut = len(points)
            if cut >= PIECE:  # a long text goes in pieces that end between words
                free = np.flatnonzero(points[:PIECE - 1] == 0)
                cut = int(free[-1]) + 1 if len(free) else PIECE - 1  # a word of a million letters is no term anyway
            if batch and size + cut + 1 > PIECE:
                yield np.concatenate(batch), spans
                batch, spans, size = [], [], 0
            spans.append((n, size))
            batch += [points[:cut], gap]
            size += cut + 1
            if cut == len(points):
                break
            points = points[cut:]
    if batch:
        yield np.concatenate(batch), spans


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words of an item's last sentence are its answer, the others its
    question; an item of one sentence is cut before its last third."""
    sentences = [w for w in (words_of(s) for s in re.split(r"[.?!\n]+", text)) if w]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = sentences[0] if sentences else []
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


def overlap(part: list[str], passage: list[str], run: int) -> float:
    """Share of the words of ``part`` that lie in runs of ``run`` words (all,
    if it has fewer) which also stand in the passage; 1 if it has none."""
    n = min(run, len(part))
    if not n:
        return 1.0
    there = {tuple(passage[k:k + n]) for k in range(len(passage) - n + 1)}
    covered = set()
    for k in range(len(part) - n + 1):
        if tuple(part[k:k + n]) in there:
            covered.update(range(k, k + n))
    return len(covered) / len(part)


class Index:
    """Inverted index of one bounded shard of items, with block maxima."""

    def __init__(self, items: list[tuple[int, str]], frequency: dict[str, int], n_items: int, mean_length: float, k1: float = 1.2, b: float = 0.75, block: int = 8):
        import numpy as np

        self.items = [(i, *question_and_answer(t)) for i, t in items]
        lengths = [len(q) + len(a) for _, q, a in self.items]
        self.longest = max(lengths, default=1)
        self.terms: dict[str, int] = {}
        postings = []
        for at, (_, q, a) in enumerate(self.items):
            counts: dict[str, int] = {}
            for w in q + a:
                counts[w] = counts.get(w, 0) + 1
            norm = k1 * (1 - b + b * lengths[at] / mean_length)
            impact = {w: math.log(1 + (n_items - frequency[w] + 0.5) / (frequency[w] + 0.5)) * c * (k1 + 1) / (c + norm) for w, c in counts.items()}
            own = sum(impact.values())
            postings += [(self.terms.setdefault(w, len(self.terms)), at, x / own) for w, x in impact.items()]
        postings.sort()
        term, item, share = (np.array(c) for c in zip(*postings, strict=True))
        n = len(self.terms)
        self.first = np.searchsorted(term, np.arange(n + 1))
        self.item, self.share, self.block = item, share, item // block
        self.n_blocks = int(self.block.max()) + 1
        self.term_max = np.maximum.reduceat(share, self.first[:-1])
        numbers = np.concatenate([word_numbers(folded(w)[:PIECE])[0] for w in self.terms])
        self.term_of = np.argsort(numbers)
        self.numbers = numbers[self.term_of]
        if len(np.unique(numbers)) < n:
            raise ValueError("two terms share a number")
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[numbers >> np.uint64(64 - FILTER_BITS)] = True
        self.term, self.n_block, self.pivots = term, block, {}

    def pivot(self, threshold: float, seen):
        """The postings that decide: of each item's terms, from the one found most often in ``seen``
        (terms of passages) on, those that hold half the threshold together are left to the
        scoring; a hit must reach the rest by the others. Returns those others by term and
        block of items (first entries, blocks, largest shares) and the largest share that is left
        to the scoring in a block. Any order is exact, so the first batch of a process sets it."""
        import numpy as np

        if threshold not in self.pivots:
            often = np.bincount(seen, minlength=len(self.terms))
            order = np.lexsort((self.share, -often[self.term], self.item))
            item, share = self.item[order], self.share[order]
            total = np.cumsum(share)
            first = np.searchsorted(item, item, side="left")
            upto = total - np.where(first > 0, total[first - 1], 0.0)
            late = upto < threshold / 2
            rest = np.zeros(self.n_blocks)
            np.maximum.at(rest, item[late] // self.n_block, upto[late])
            term, block, share = self.term[order][~late], item[~late] // self.n_block, share[~late]
            order = np.lexsort((block, term))
            term, block, share = term[order], block[order], share[order]
            edge = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])))
            first = np.searchsorted(term[edge], np.arange(len(self.terms) + 1))
            self.pivots[threshold] = first, block[edge], np.maximum.reduceat(share, edge), rest
        return self.pivots[threshold]

    def lookup(self, numbers):
        """(which words are terms, their terms)."""
        import numpy as np

        some = np.flatnonzero(self.filter[numbers >> np.uint64(64 - FILTER_BITS)])
        at = np.minimum(np.searchsorted(self.numbers, numbers[some]), len(self.numbers) - 1)
        hit = self.numbers[at] == numbers[some]
        return some[hit], self.term_of[at[hit]]

    @staticmethod
    def _spread(first, terms):
        """Places of all entries of the terms, and which term each is of."""
        import numpy as np

        many = first[terms + 1] - first[terms]
        owner = np.repeat(np.arange(len(terms)), many)
        return np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - first[terms], many), owner

    def retrieve(self, passage, term, n_passages: int, threshold: float):
        """Distinct (passage, term) pairs to all (passage, item, score) at or above the threshold."""
        import numpy as np

        slack = threshold - 1e-9
        bound = np.bincount(passage, self.term_max[term], n_passages)
        live = bound[passage] >= slack
        passage, term = passage[live], term[live]
        if not len(passage):
            return []
        alive, passage = np.unique(passage, return_inverse=True)
        block_first, block_of, block_max, rest = self.pivot(threshold, term)
        places, owner = self._spread(block_first, term)
        cell = passage[owner] * self.n_blocks + block_of[places]
        cells, where = np.unique(cell, return_inverse=True)
        reach = np.bincount(where, block_max[places]) + rest[cells % self.n_blocks] >= slack
        open_cells = cells[reach]
        if not len(open_cells):
            return []
        live = np.isin(passage, open_cells // self.n_blocks)
        passage, term = passage[live], term[live]
        places, owner = self._spread(self.first, term)
        inside = np.isin(passage[owner] * self.n_blocks + self.block[places], open_cells)
        places, owner = places[inside], owner[inside]
        pairs, where = np.unique(passage[owner] * len(self.items) + self.item[places], return_inverse=True)
        scores = np.bincount(where, self.share[places])
        good = scores >= slack
        return [(int(alive[p // len(self.items)]), int(p % len(self.items)), float(s)) for p, s in zip(pairs[good], scores[good], strict=True)]

    def leaks(self, texts, threshold: float, least: float, whole: float, run: int) -> list[list[dict]]:
        """For each text its leaked items."""
        import numpy as np

        step, n_terms = self.longest, len(self.terms)
        count = np.zeros(len(texts), np.int64)  # words so far
        doc, place, term = [], [], []
        for points, spans in _pieces(texts):
            numbers, starts = word_numbers(points)
            owners, begins = np.array([n for n, _ in spans]), np.array([at for _, at in spans])
            first = np.searchsorted(starts, begins)
            at, terms = self.lookup(numbers)
            span = np.searchsorted(begins, starts[at], "right") - 1
            place.append(at - first[span] + count[owners[span]])
            doc.append(owners[span])
            term.append(terms)
            np.add.at(count, owners, np.diff(np.append(first, len(starts))))
        base = np.cumsum(count // step + 1) - (count // step + 1)
        doc, place, term = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (doc, place, term))
        window = place // step + base[doc]
        n_windows = int((count // step + 1).sum())
        back = place >= step  # a passage also holds the words of the next step
        distinct = np.sort(np.concatenate([window * n_terms + term, (window[back] - 1) * n_terms + term[back]]))
        distinct = distinct[np.append(True, distinct[1:] != distinct[:-1])] if len(distinct) else distinct
        found: list[dict] = [{} for _ in range(len(texts))]
        lists: dict[int, list[str]] = {}
        for passage, item, score in self.retrieve(distinct // n_terms, distinct % n_terms, n_windows, threshold) if len(distinct) else []:
            doc = int(np.searchsorted(base, passage, "right")) - 1
            item_id, question, answer = self.items[item]
            low = (passage - int(base[doc])) * step
            if doc not in lists:
                lists = {doc: words_of(texts[doc])}  # passages come in order of documents
            near = lists[doc][max(0, low - step):low + 3 * step]
            q, a = overlap(question, near, run), overlap(answer, near, run)
            share = (q * len(question) + a * len(answer)) / (len(question) + len(answer))
            if q >= least and (a >= least or share >= whole) and score > found[doc].get(item, {"score": -1})["score"]:
                found[doc][item] = {"item_id": item_id, "score": min(1.0, score), "question_overlap": q, "answer_overlap": a}
        return [list(f.values()) for f in found]


def _loaded(path: str) -> Index:
    """A written shard; a process keeps those of one pass."""
    cache = _process_cache().setdefault("decontam", {})
    if path not in cache:
        while len(cache) >= SHARDS_A_PASS:
            cache.pop(next(iter(cache)))
        system, place = filesystem(path)
        with system.open_input_stream(place) as src:
            own = Index.__new__(Index)
            own.__dict__ = pickle.loads(src.read())
        cache[path] = own
    return cache[path]


def _leaks_udf(paths: list[str], threshold: float, least: float, whole: float, run: int):
    @F.pandas_udf(LEAK)
    def leaks(texts: pd.Series) -> pd.Series:
        texts = list(texts)
        each = [_loaded(p).leaks(texts, threshold, least, whole, run) for p in paths]
        return pd.Series([sum(found, []) for found in zip(*each, strict=True)], dtype=object)

    return leaks


def _write_index(folder: str, n_items: int, mean_length: float):
    """cogroup: the items of a shard and the frequencies of its terms to one index file."""

    def run(items, terms):
        import pyarrow as pa

        rows = [(i, t) for i, t in zip(items["item_id"].to_pylist(), items["text"].to_pylist(), strict=True) if words_of(t)]
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        index = Index(rows, dict(zip(terms["term"].to_pylist(), terms["n"].to_pylist(), strict=True)), n_items, mean_length)
        path = f"{folder}/{uuid.uuid4().hex}.index"
        system, place = filesystem(path)
        with system.open_output_stream(place) as out:
            out.write(pickle.dumps(vars(index)))  # plain arrays
        return pa.table({"path": [path]})

    return run


def with_leaks(docs: DataFrame, items: DataFrame, name: str = "leaks", threshold: float = 0.6, least: float = 0.6, whole: float = 0.8, run: int = 5, shard_items: int = 20_000, shard_chars: int = 16_000_000) -> DataFrame:
    """The frame with the array of items that leak into ``text``.

    ``threshold`` is the least BM25 score as a share of the item's own,
    ``least`` the overlap that question and answer need each (``whole``: the
    overlap of the whole item that makes up for a changed answer), ``run`` the
    words of a shingle. ``items`` (item_id, text) are indexed in
    shards of about ``shard_items`` items and ``shard_chars`` characters (a
    single longer item makes a larger one). One scan serves ``SHARDS_A_PASS`` shards;
    with more, the frame is written between passes. Items without words are ignored; a null text has no leaks.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    pattern = r"[\p{L}\p{M}\p{N}_]+"
    usable = items.select("item_id", "text").where(F.coalesce(F.col("text"), F.lit("")).rlike(pattern))
    total = usable.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
    out = docs.withColumn(name, F.array().cast(LEAK))
    if not total.n:
        return out
    shards = max(-(-total.n // shard_items), -(-total.chars // shard_chars))

    def terms(parts):
        for part in parts:
            for shard, text in zip(part["shard"], part["text"], strict=True):
                words = words_of(text)
                yield pd.DataFrame({"shard": shard, "term": list(dict.fromkeys(words)) + [None], "n": [1] * len(set(words)) + [len(words)]})

    usable = settle(usable.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int")), "items")
    own = settle(usable.mapInPandas(terms, "shard int, term string, n long"), "terms")
    length = own.where("term is null").agg(F.sum("n").alias("n")).first().n
    if not length:
        return out
    frequency = own.where("term is not null").groupBy("term").agg(F.sum("n").alias("n"))
    wanted = own.where("term is not null").select("shard", "term").distinct().join(frequency, "term")
    worded = own.where("term is null and n > 0").select("shard").distinct()
    folder = scratch(spark, "benchmark")
    make_folder(folder)
    built = usable.join(worded, "shard", "left_semi").groupBy("shard").cogroup(wanted.groupBy("shard")).applyInArrow(
        _write_index(folder, total.n, length / total.n), "path string")
    paths = sorted(r.path for r in settle(built, "shards").collect())  # one row per shard
    for at in range(0, len(paths), SHARDS_A_PASS):
        leaks = _leaks_udf(paths[at:at + SHARDS_A_PASS], threshold, least, whole, run)
        out = out.withColumn(name, F.concat(name, leaks("text")))
        if at + SHARDS_A_PASS < len(paths):
            out = settle(out, "leaks")
    return out


def contamination(docs: DataFrame, items: DataFrame, **limits) -> DataFrame:
    """One row per leaked pair: doc_id, item_id, score, question_overlap,
    answer_overlap. Documents without leaks give no row; repeated rows of a
    document give the pair once, with the largest figures; a null doc_id is
    one document. Empty tables give an empty result."""
    found = with_leaks(docs.select("doc_id", "text"), items, **limits).select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
    return found.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")])


def keep_clean(docs: DataFrame, items: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` (all columns) into which no item leaks."""
    own = "__rowtide_leaks"
    return with_leaks(docs, items, own, **limits).where(F.size(own) == 0).drop(own)
