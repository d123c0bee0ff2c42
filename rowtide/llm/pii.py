"""Personal data by bootstrapped contextual extraction, in DataFrame functions.

Fixed patterns find the base entities (mail addresses, IP addresses, cards,
phone numbers). They and a few shapes (``SEEDS``) are the seeds. Every word
with digits is an instance; what stands around it gives its lexical patterns:
the two words to its left, and the word to its left with the word to its
right, digits in them read as 0. On the graph of patterns and instances confidence goes back and forth:
a pattern is worth the share of its instances that are believed to be of a
kind, an instance what the patterns around it make likely. Patterns that end
up confident name the identifiers that no fixed pattern describes.

Texts are scanned once; the graph holds words, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.io import settle

#: fixed values of the contract, in its order. The expressions match what the
#: contract's do; they start only where a match can, and never backtrack into
#: a run, so long runs cost linear time.
BASE = (
    ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", r"[0-9](?:[\x20-]?+[0-9])++"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
#: kinds that only the method adds, with the shape that seeds them
SEEDS = (("secret", "^[0-9a-f]{32,}$"),)
KINDS = tuple(k for k, _ in BASE) + tuple(k for k, _ in SEEDS)

#: a word with a digit, from the start of the word
_WORD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
_OPENING = r"""^[^0-9A-Za-z+]*"""
_CLOSING = r"""[^0-9A-Za-z]*$"""
_CONTEXT = 80  # characters around an instance in which its context is sought


def _running(steps: Column, made: str, step, run: int = 128) -> Column:
    """What ``step(acc, one)`` appends to ``acc.out``, with ``acc.at`` carried
    along the array. Runs of the array are gathered apart and then joined: an
    append copies what is there, so a single pass would be quadratic."""
    empty = F.array().cast(f"array<{made}>")

    def of_run(acc: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(acc.at.alias("at"), empty.alias("out")), step)
        return F.struct(inner.at.alias("at"), F.concat(acc.out, F.array(inner.out)).alias("out"))

    def of_all(bound: Column) -> Column:  # the array is bound to a variable, so it is made once
        last = F.greatest(F.floor((F.size(bound) - 1) / run).cast("int"), F.lit(0))
        parts = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(bound, k * run + 1, run))
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{made}>>").alias("out"))
        return F.aggregate(parts, zero, of_run, lambda acc: F.flatten(acc.out))

    return F.get(F.transform(F.array(steps), of_all), F.lit(0))


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, match) of all matches, left to right, in code
    points: the lengths of the matches and of what lies between them."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.filter(F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("match"))), lambda s: s.match.isNotNull())
    def step(acc: Column, s: Column) -> Column:
        start = acc.at + s.gap
        end = start + F.length(s.match)
        return F.struct(end.alias("at"), F.concat(acc.out, F.array(F.struct(start.alias("start"), end.alias("end"), s.match.alias("match")))).alias("out"))

    return _running(steps, "struct<start:int,end:int,match:string>", step)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


_KEEPS = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3) & (F.substring(p, -3, 3).cast("int") <= 255)),
    "card": lambda m: F.length(_digits(m)).between(12, 19) & F.call_function("luhn_check", _digits(m)),
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}
_MAY = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}


def base_spans(text: Column) -> Column:
    """Array of (start, kind's place, end, kind), in this order."""
    none = F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")

    def of_kind(place: int, kind: str, pattern: str) -> Column:
        good = F.filter(_matches(text, pattern), lambda m: _KEEPS[kind](m.match))
        found = F.transform(good, lambda m: F.struct(m.start.alias("start"), F.lit(place).alias("place"), m.end.alias("end"), F.lit(kind).alias("kind")))
        return F.when(text.rlike(_MAY[kind]), found).otherwise(none)

    kinds = [of_kind(place, kind, pattern) for place, (kind, pattern) in enumerate(BASE)]
    return F.array_sort(F.concat(*kinds))


def _instances(text: Column) -> Column:
    """Array of (start, end, core, patterns) of the words with digits."""
    empty = F.array(F.lit(""))

    def beside(both: Column) -> Column:
        """Each instance with the text around it, up to the second instance before and the next one after."""
        gaps, found = both.gaps, both.found
        rest = lambda c: F.concat(F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0))), empty)
        zipped = F.arrays_zip(gaps.alias("gap"), found.alias("match"), F.concat(empty, empty, found).alias("second"), F.concat(empty, gaps).alias("past"),
                              F.concat(empty, found).alias("first"), rest(gaps).alias("after"), rest(found).alias("next"))
        return F.transform(F.filter(zipped, lambda s: s.match.isNotNull()), lambda s: F.struct(
            s.gap.alias("gap"), s.match.alias("match"), F.concat(s.second, s.past, s.first, s.gap).alias("before"), F.concat(s.after, s.next).alias("after")))

    both = F.struct(F.split(text, _WORD, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)).alias("found"))
    steps = F.get(F.transform(F.array(both), beside), F.lit(0))  # bound to a variable, so both are made once

    def step(acc: Column, s: Column) -> Column:
        at = acc.at + F.length(s.gap)
        open_ = F.length(F.regexp_extract(s.match, _OPENING, 0))  # none is length 0; regexp_substr makes it null
        core = F.regexp_replace(F.regexp_replace(s.match, _OPENING, ""), _CLOSING, "")
        one = F.struct((at + open_).alias("start"), (at + open_ + F.length(core)).alias("end"), core.alias("core"),
                       F.substring(s.before, -_CONTEXT, _CONTEXT).alias("before"), F.substring(s.after, 1, _CONTEXT).alias("after"))
        return F.struct((at + F.length(s.match)).alias("at"), F.concat(acc.out, F.array(one)).alias("out"))

    return _running(steps, "struct<start:int,end:int,core:string,before:string,after:string>", step)


def _row_key(doc_id: Column, text: Column) -> Column:
    """Tells rows apart by id and text; rows that repeat both share everything."""
    return F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("-")), F.coalesce(text, F.lit(""))))


def scan(docs: DataFrame) -> DataFrame:
    """One pass over the texts: row_key, doc_id, base, instances."""
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<start:int,end:int,core:string,before:string,after:string>>")
    return settle(docs.select(
        "doc_id", _row_key(F.col("doc_id"), F.col("text")).alias("row_key"), base_spans(text).alias("base"),
        F.when(text.rlike("[0-9]"), _instances(text)).otherwise(none).alias("instances")), "pii-scan")


def _occurrences(scanned: DataFrame, least_chars: int, least_digits: int) -> DataFrame:
    """Distinct rows (row_key, start, end, instance, kind, pattern): kind is the
    seed kind of the instance there, or null."""
    words = scanned.dropDuplicates(["row_key"]).select("row_key", "base", F.explode("instances").alias("i")).select("row_key", "base", "i.*")
    inside = F.filter("base", lambda b: (b.start < F.col("end")) & (b.end > F.col("start")))
    shaped = [F.when(F.col("core").rlike(shape), F.lit(name)) for name, shape in SEEDS]
    kind = F.coalesce(*shaped, F.get(inside, F.lit(0)).kind)  # digits in a longer seed are no card
    tidy = lambda c: F.regexp_replace(F.lower(c), "[0-9]", "0")
    left_two = tidy(F.regexp_extract("before", r"(\S+\s+\S+)\s+$", 1))
    left, right = tidy(F.regexp_extract("before", r"(\S+)\s+$", 1)), tidy(F.regexp_extract("after", r"^\s+(\S+)", 1))
    patterns = F.array(F.when(left_two != "", F.concat(F.lit("left:"), left_two)),
                       F.when((left != "") & (right != ""), F.concat(F.lit("both:"), left, F.lit(" _ "), right)))
    long_enough = (F.length("core") >= least_chars) & (F.length(_digits(F.col("core"))) >= least_digits)
    return words.where(long_enough).select(
        "row_key", "start", "end", F.col("core").alias("instance"), kind.alias("kind"),
        F.explode(F.filter(patterns, lambda p: p.isNotNull())).alias("pattern"))


def confident_patterns(seen: DataFrame, rounds: int = 3, least: float = 0.8, least_shaped: float = 0.4, support: int = 4) -> DataFrame:
    """(pattern, kind, confidence) from occurrences (instance, kind, pattern).

    Each round scores the patterns by their instances, keeps those with
    confidence ``least`` from at least ``support`` believed instances (a score of 0.8), and
    scores the instances by the kept patterns; seeds stay certain. A kind that a
    fixed pattern describes in full is seen wherever it stands, so an instance
    that is not of it speaks against a pattern. A shape only describes a part of its kind:
    ``least_shaped`` is enough there, and the rounds raise what such patterns agree on.
    """
    edges = settle(seen.select("pattern", "instance").distinct(), "pii-edges")
    totals = settle(edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= support), "pii-totals")
    seeds = settle(seen.where("kind is not null").groupBy("instance").agg(F.min("kind").alias("kind")).withColumn("score", F.lit(1.0)), "pii-seeds")
    belief, kept = seeds, None
    for _ in range(rounds):
        good = edges.join(belief, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("good"), F.count(F.when(F.col("score") >= 0.8, 1)).alias("m"))
        enough = F.when(F.col("kind").isin(*[k for k, _ in SEEDS]), least_shaped).otherwise(least)
        kept = settle(good.where(F.col("m") >= support).join(totals, "pattern").withColumn("confidence", F.col("good") / F.col("n"))
                      .where(F.col("confidence") >= enough).groupBy("pattern")
                      .agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"), F.max("confidence").alias("confidence")), "pii-patterns")
        doubt = F.sum(F.log(F.lit(1.0) - F.least("confidence", F.lit(0.99))))
        told = edges.join(kept, "pattern").groupBy("instance", "kind").agg((F.lit(1.0) - F.exp(doubt)).alias("score"))
        best = told.union(seeds.select("instance", "kind", "score")).groupBy("instance").agg(F.max_by(F.struct("kind", "score"), F.struct("score", "kind")).alias("top"))
        belief = settle(best.select("instance", "top.kind", "top.score"), "pii-belief")
    return kept


def extract(docs: DataFrame, least_chars: int = 8, least_digits: int = 4, **limits) -> tuple[DataFrame, DataFrame]:
    """(scanned, added): the scan of ``docs`` and the spans that the method
    adds, one row per row_key with an array of (start, place, end, kind).

    ``least_chars`` and ``least_digits`` are what an instance has at least.
    A word that a base span touches is not added, unless it has a seed's shape.
    A seed in no confident pattern adds nothing: the shape alone is no proof.
    """
    scanned = scan(docs.select("doc_id", "text"))
    seen = settle(_occurrences(scanned, least_chars, least_digits), "pii-occurrences")
    patterns = confident_patterns(seen, **limits)
    base_kinds = [k for k, _ in BASE]
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    new = seen.where(F.col("kind").isNull() | ~F.col("kind").isin(base_kinds)).drop("kind").join(patterns, "pattern")
    chosen = new.groupBy("row_key", "start", "end").agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
    added = chosen.select("row_key", F.struct("start", place.alias("place"), "end", "kind").alias("span"))
    return scanned, settle(added.groupBy("row_key").agg(F.array_sort(F.collect_list("span")).alias("added")), "pii-added")


def spans(docs: DataFrame, **limits) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; others ignored): doc_id,
    base and found (base and added spans), arrays of (start, place, end, kind)
    by start, then kind.

    A null text is empty; rows that repeat id and text get the same spans; an
    empty table gives an empty result.
    """
    scanned, added = extract(docs, **limits)
    none = F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")
    return scanned.join(added, "row_key", "left").select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", none))).alias("found"))


def listed(found: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def redact(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` with each span of ``text`` replaced by its kind in
    angle brackets and ``n_chars`` counted anew; other columns stay. Spans that
    overlap are replaced together, under the first one's kind."""
    _, added = extract(docs, **limits)
    key, more = "__rowtide_key", "__rowtide_added"
    text = F.col("text")
    none = F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")
    marked = docs.withColumn(key, _row_key(F.col("doc_id"), text)).join(added.select(F.col("row_key").alias(key), F.col("added").alias(more)), key, "left")
    found = F.array_sort(F.concat(base_spans(text), F.coalesce(F.col(more), none)))

    def step(acc: Column, s: Column) -> Column:
        apart = s.start >= acc.at
        piece = F.when(apart, F.concat(acc.out, F.array(F.concat(F.substring(text, acc.at + 1, s.start - acc.at), F.lit("<"), F.upper(s.kind), F.lit(">"))))).otherwise(acc.out)
        return F.struct(F.greatest(acc.at, s.end).alias("at"), piece.alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    clean = F.aggregate(found, zero, step, lambda acc: F.concat(F.array_join(acc.out, ""), F.substring(text, acc.at + 1, F.length(text))))
    out = marked.withColumn("text", F.when(F.size(found) > 0, clean).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
