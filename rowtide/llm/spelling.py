"""Spelling variants: words that differ by one code point, by search schemes over
bidirectional FM-indexes of the delimited vocabulary.

A word and a near word (one code point inserted, deleted or replaced) agree in the
first or in the last half of the word. Two searches follow from that. The first
matches the first half exactly, to the left up to the delimiter, and then goes on to
the right over the second half with one error; the second matches the last half
exactly, to the right up to the delimiter, and goes on to the left over the first
half with one error. Both start in the middle of the word and turn round, so the
index is bidirectional: a match is an interval of suffix ranks in the text
and one in its mirror image, kept in step. A match that ends in both delimiters is one
word. What both searches would find counts in the first only: the second leaves
out near words that start with the first half.

Scale: the vocabulary is ordered by word (for the first search) and by mirrored word
(for the second) and cut into shards of about ``SHARD_WORDS`` words, each a range.
The words that start with a half stand in few neighbouring shards, and the
query word goes to these alone; its place among the shards comes from their edges,
one short row per shard, which is all that is broadcast. A task holds one shard
and at most about ``SLICE_ROWS`` of its queries: where a short half asks for more, the
shard is handed out several times. Searches of a task run together as arrays, one
code point a step. A task returns one row per query: how many words are near and
the best of them, so no pair is ever written.

Counting words is a plain aggregation (partial before the shuffle); forms are followed
by pointer jumping, as each form has at least twice the count of its word and so
no chain is longer than the logarithm of the largest count.

Recovery: vocabulary, shards and answers are written tables; a lost task repeats a
shard and a slice.

Edge cases: null texts hold no words; a null ``doc_id`` counts as an empty one in the
checksum; repeated rows count each; a table without words gives no rows. Words
of any length are whole; a search takes one step per code point, so a word of a
million letters costs a million steps. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.io import batches_of, settle

SHARD_WORDS, SLICE_ROWS = 20_000, 40_000
#: longest part of a word that is kept as the edge of a shard
EDGE = 64

# The contract's letters and the rarity of planted slips.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP, LEAST_LENGTH, LEAST_COUNT = 97, 5, 3

END, BORDER = 0, 1  # codes of the end of the text and of the delimiter; letters follow


def vocabulary(docs: DataFrame) -> DataFrame:
    """(``word``, ``n``): the words of all whole texts, after the slips."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    words = runs.withColumn("h", h).withColumn("at", at).select(F.when(F.col("h") % SLIP == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


# -- the index -------------------------------------------------------------------


def suffix_ranks(text):
    """The suffix array of an integer text, by prefix doubling."""
    import numpy as np

    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, step = len(text), 1
    while True:
        after = np.full(n, -1, np.int64)
        after[:n - step] = rank[step:] if step < n else after[:0]
        key = rank * (n + 1) + after + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = new
        if rank.max() == n - 1 or step >= n:
            return order
        step *= 2


class Ranks:
    """Burrows-Wheeler transform of a text as a wavelet matrix: how often a code
    stands before a place, and how many smaller codes stand in an interval."""

    def __init__(self, text, codes: int):
        import numpy as np

        self.places = suffix_ranks(text)
        bwt = text[self.places - 1]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=codes))]).astype(np.int64)
        self.levels, seq = [], bwt
        for bit in reversed(range(max(1, (codes - 1).bit_length()))):
            ones = (seq >> bit) & 1
            zeros = np.concatenate([[0], np.cumsum(ones == 0)]).astype(np.int32)
            self.levels.append((bit, zeros, int(zeros[-1])))
            seq = np.concatenate([seq[ones == 0], seq[ones == 1]])

    def narrow(self, code, low, high):
        """Intervals after one more code in front, and how many smaller codes stood
        in the old ones (which moves the interval of the mirrored text)."""
        import numpy as np

        a, b, smaller = low, high, np.zeros(len(low), np.int64)
        for bit, zeros, n_zeros in self.levels:
            one = (code >> bit) & 1 == 1
            za, zb = zeros[a].astype(np.int64), zeros[b].astype(np.int64)
            smaller += np.where(one, zb - za, 0)
            a, b = np.where(one, a - za + n_zeros, za), np.where(one, b - zb + n_zeros, zb)
        first = self.starts[code]
        return first + a - self._base(code), first + b - self._base(code), smaller

    def _base(self, code):
        """Where a code's run begins at the bottom of the matrix."""
        import numpy as np

        if not hasattr(self, "bottoms"):
            every = np.arange(len(self.starts) - 1)
            at = np.zeros(len(every), np.int64)
            for bit, zeros, n_zeros in self.levels:
                z = zeros[at].astype(np.int64)
                at = np.where((every >> bit) & 1 == 1, at - z + n_zeros, z)
            self.bottoms = at
        return self.bottoms[code]

    def children(self, low, high):
        """Every code that stands in an interval: (which interval, code, new interval)."""
        import numpy as np

        row, code, a, b = np.arange(len(low)), np.zeros(len(low), np.int64), low, high
        for bit, zeros, n_zeros in self.levels:
            za, zb = zeros[a].astype(np.int64), zeros[b].astype(np.int64)
            left, right = zb > za, (b - a) > (zb - za)
            row = np.concatenate([row[left], row[right]])
            code = np.concatenate([code[left], code[right] | (1 << bit)])
            a, b = np.concatenate([za[left], (a - za + n_zeros)[right]]), np.concatenate([zb[left], (b - zb + n_zeros)[right]])
        first = self.starts[code] - self._base(code)
        return row, code, first + a, first + b


class BidirectionalIndex:
    """The words of one shard, between delimiters, and the mirror image of that text."""

    def __init__(self, words: list[str]):
        import numpy as np

        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.letters = np.unique(points)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(lengths + 1)  # the delimiter behind each word
        text = np.full(len(points) + len(words) + 2, BORDER, np.int64)
        inner = np.ones(len(text), bool)
        inner[0] = inner[-1] = False
        inner[self.ends] = False
        text[inner] = np.searchsorted(self.letters, points) + 2
        text[-1] = END
        self.size = len(text)
        self.codes = len(self.letters) + 3  # one more for letters that no word has
        self.text = Ranks(text, self.codes)
        self.mirror = Ranks(np.concatenate([text[:-1][::-1], [END]]), self.codes)

    def coded(self, words: list[str]):
        """(codes of all words one after the other, where each begins)."""
        import numpy as np

        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])
        at = np.searchsorted(self.letters, points)
        known = at < len(self.letters)
        known[known] = self.letters[at[known]] == points[known]
        return np.where(known, at + 2, self.codes - 1).astype(np.int64), starts

    def search(self, words: list[str], right: bool):
        """(query, word) pairs of near words. ``right``: the first half is exact and the
        error is to the right; else the last half is exact and the error to the left."""
        import numpy as np

        codes, starts = self.coded(words)
        lengths = np.diff(starts)
        half = lengths // 2
        # exact part: from the middle outwards, then the delimiter
        query = np.arange(len(words))
        steps = (half if right else lengths - half) + 1
        inner, outer = (self.text, self.mirror) if right else (self.mirror, self.text)
        low, high = np.zeros(len(words), np.int64), np.full(len(words), self.size, np.int64)
        other = np.zeros(len(words), np.int64)  # low end in the index of the other direction
        for j in range(int(steps.max(initial=0))):
            going = j < steps[query]
            q = query[going]
            place = starts[q] + (half[q] - 1 - j if right else half[q] + j)
            last = j == steps[q] - 1
            code = np.where(last, BORDER, codes[np.where(last, 0, place)] if len(codes) else BORDER)
            a, b, smaller = inner.narrow(code, low[going], high[going])
            low[going], high[going] = a, b
            other[going] += smaller
            keep = high > low
            query, low, high, other = query[keep], low[keep], high[keep], other[keep]
        low, high = other, other + (high - low)

        # the other way: the rest of the word, one error, the delimiter
        rest = lengths - half if right else half

        def wanted(q, j):
            """The next code of the rest; the delimiter behind it."""
            inside = j < rest[q]
            place = starts[q] + np.where(inside, half[q] + j if right else half[q] - 1 - j, 0)
            return np.where(inside, codes[np.minimum(place, len(codes) - 1)], BORDER)

        found_q, found_at = [], []
        clean = (query, low, high)  # no error so far, all at the same step
        dirty = (np.empty(0, np.int64),) * 4  # after the error: query, step of the rest, interval
        j = 0
        while len(clean[0]) or len(dirty[0]):
            q, low, high = clean
            if len(q):
                want, ahead = wanted(q, j), wanted(q, j + 1)
                row, code, a, b = outer.children(low, high)
                letter = (code > BORDER) & (code != want[row])
                row, a, b = row[letter], a[letter], b[letter]
                more = j < rest[q[row]]  # a letter is left to be replaced
                gone = (j < rest[q]) & (want != ahead)  # of a run of one letter, the last is left out
                parts = [(q[row], np.full(len(row), j), a, b),  # a letter too many, unless it repeats the next
                         (q[row][more], np.full(int(more.sum()), j + 1), a[more], b[more]),  # another letter
                         (q[gone], np.full(int(gone.sum()), j + 1), low[gone], high[gone])]  # a letter too few
                dirty = tuple(np.concatenate([d, *new]) for d, new in zip(dirty, zip(*parts, strict=True), strict=True))
                step = j < rest[q]
                a, b, _ = outer.narrow(want[step], low[step], high[step])
                alive = b > a
                clean = q[step][alive], a[alive], b[alive]
            q, at, low, high = dirty
            if len(q):
                a, b, _ = outer.narrow(wanted(q, at), low, high)
                alive = b > a
                done = alive & (at >= rest[q])
                found_q.append(q[done])
                found_at.append(outer.places[a[done]])
                on = alive & ~done
                dirty = q[on], at[on] + 1, a[on], b[on]
            j += 1
        q = np.concatenate([*found_q, np.empty(0, np.int64)]).astype(np.int64)
        at = np.concatenate([*found_at, np.empty(0, np.int64)]).astype(np.int64)
        # both directions end on a delimiter: the one behind the word in the mirror, the one before it in the text
        before = self.size - 2 - at if right else at
        word = np.searchsorted(self.ends, before, side="left" if right else "right")
        return q, word


# -- the search over shards --------------------------------------------------------


def _answers(right: bool):
    """cogroup: one shard (words, n) and a slice of its queries to one row per query."""

    def run(shard, queries):
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])
        if not shard.num_rows or not queries.num_rows:
            return schema.empty_table()
        shard = shard.sort_by("word")  # by UTF-8 bytes, hence by code point
        words, n = shard["word"].to_pylist(), shard["n"].to_numpy()
        asked = queries["word"].to_pylist()
        q, near = BidirectionalIndex(words).search(asked, right)
        if not right:  # the first search has those that start with the first half
            new = np.fromiter((not words[w].startswith(asked[a][:len(asked[a]) // 2]) for a, w in zip(q.tolist(), near.tolist(), strict=True)), bool, len(q))
            q, near = q[new], near[new]
        order = np.lexsort((near, -n[near], q))  # words are in code-point order
        q, near = q[order], near[order]
        each, first, count = np.unique(q, return_index=True, return_counts=True)
        best = near[first]
        return pa.table([[asked[a] for a in each.tolist()], count.astype(np.int64), n[best], [words[w] for w in best.tolist()]], schema=schema)

    return run


def _near(words: DataFrame, right: bool) -> DataFrame:
    """Answers of one search: (``word``, ``n_near``, ``form_n``, ``form``) per shard and query."""
    spark = words.sparkSession
    key = F.col("word") if right else F.reverse("word")
    parts = max(1, -(-words.count() // SHARD_WORDS))
    shards = settle(words.withColumn("key", key).repartitionByRange(parts, "key").withColumn("shard", F.spark_partition_id()), "shards")
    high = "\U0010ffff"
    edges = shards.groupBy("shard").agg(F.min(F.substring("key", 1, EDGE)).alias("a"), F.max(F.substring("key", 1, EDGE)).alias("z"))
    edges = sorted((r.a, r.z + high, r.shard) for r in edges.collect())  # one row per shard
    firsts, lasts, ids = ([e[i] for e in edges] for i in range(3))

    @F.pandas_udf("array<int>")
    def shards_of(halves: pd.Series) -> pd.Series:
        return pd.Series([ids[bisect.bisect_left(lasts, h):bisect.bisect_right(firsts, h + high)] for h in halves])

    size = F.floor(F.length("word") / 2).cast("int")
    half = F.substring("word", F.lit(1), size) if right else F.reverse(F.substring("word", size + 1, F.length("word")))
    asked = words.withColumn("half", half).select("word", F.explode(shards_of("half")).alias("shard"))
    slices = asked.groupBy("shard").agg(F.ceil(F.count("*") / SLICE_ROWS).alias("slices"))
    asked = asked.join(slices, "shard").select("word", "shard", F.pmod(F.xxhash64("word"), F.col("slices")).alias("slice"))
    copies = shards.join(slices, "shard").select("word", "n", "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
    tasks = max(parts, spark.sparkContext.defaultParallelism)
    pair = asked.repartition(tasks, "shard", "slice").groupBy("shard", "slice")
    return copies.repartition(tasks, "shard", "slice").groupBy("shard", "slice").cogroup(pair).applyInArrow(
        _answers(right), "word string, n_near long, form_n long, form string")


def _roots(forms: DataFrame) -> DataFrame:
    """(``word``, ``root``): each word's form followed to the last, by pointer jumping."""
    jumps = settle(forms.select("word", F.col("form").alias("root")), "jumps")
    while True:
        onward = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = settle(jumps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                 F.col("next").isNotNull().alias("moved")), "jumps")
        jumps = moved.drop("moved")
        if not moved.where("moved").take(1):
            return jumps


def variants(words: DataFrame) -> DataFrame:
    """A vocabulary (distinct ``word``, ``n``) with ``form`` (the near word of largest n, the
    smallest in code-point order in a tie, if its n is at least twice the word's),
    ``root`` (forms followed to the last), ``n_near`` and ``form_n``."""
    with batches_of(words.sparkSession, 10_000):
        words = settle(words, "vocabulary")
        found = settle(_near(words, right=True).unionByName(_near(words, right=False)), "near")
    best = F.min(F.struct((-F.col("form_n")).alias("minus_n"), "form")).alias("best")  # strings compare by code point
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).withColumn("best_n", -F.col("best.minus_n"))
    joined = settle(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        *[F.when(F.col("best_n") >= 2 * F.col("n"), F.col(c)).alias(a) for c, a in (("best.form", "form"), ("best_n", "form_n"))]), "forms")
    roots = _roots(joined.where("form IS NOT NULL"))
    return joined.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
