"""Group spelling variants: words one edit apart, found by asymmetric chunks.

The shorter word of a pair (of equal ones, the lesser) contributes two disjoint chunks,
its halves ``[0, q)`` and ``[q, m)`` with ``q = m // 2``; the other word its positional
grams of those lengths.  One inserted, deleted or replaced code point leaves one half
whole, and the whole half lies at its own place or, if the other word is longer by one,
at shift one: the first half at shift 0, the second at the difference of the lengths.
Only those grams are posted.  Pairs that meet are verified by their edit distance.

A crowded gram (more than ``CROWD`` words) is not paired: its words post, within the
gram, the rest of the word with each code point left out in turn, so that only true
pairs meet.  The number of words that share such a posting is bounded by the alphabet.

Counting runs is Python over Arrow batches (one pass of a regular expression and one
checksum per distinct run of a text); everything else is DataFrame operations.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umpire.session import ensure_checkpoint_dir

LETTERS = "A-Za-zÀ-ÿ"
LOWER = {c: c + 32 for c in range(65, 91)}
SLICE = 1 << 20
WORDS = 100_000
CROWD = 200
BROADCAST_ROWS = 100_000


def runs_of(text: str, least: int):
    """Maximal letter runs of at least ``least`` code points, and their counts, from a
    slice of the text at a time; a slice ends where a run ends."""
    run, rest = re.compile(f"[{LETTERS}]{{{least},}}"), re.compile(f"[{LETTERS}]*")
    at = 0
    while at < len(text):
        end = min(at + SLICE, len(text))
        end = rest.match(text, end).end()
        yield from Counter(run.findall(text, at, end)).items()
        at = end


def altered(doc_id: str, run: str, every: int) -> str:
    """The lower-cased run, less one code point if ``every`` divides its checksum."""
    low = run.lower() if run.isascii() else run.translate(LOWER)
    h = zlib.crc32(f"{doc_id}:{low}".encode())
    if h % every == 0:
        at = h % len(low)
        low = low[:at] + low[at + 1:]
    return low


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 6,
                least_count: int = 5, every: int = 199) -> DataFrame:
    """(word, n) of words of enough code points that occur often enough.

    A null text has no words; a null id counts as an empty one in the checksum.  Runs are
    counted per text and batch before they are shuffled."""
    def count(batches):
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                doc_id = doc_id or ""
                for run, n in runs_of(text or "", least_chars):
                    word = altered(doc_id, run, every)
                    if len(word) >= least_chars:
                        held[word] += n
                if len(held) >= WORDS:
                    yield rows(held)
                    held.clear()
        yield rows(held)

    def rows(held):
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    return (docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count))


def _postings(word: Column, least: int) -> Column:
    """A word's halves, and its grams that a word shorter by one may have as halves:
    (m, part, piece, rest, longer)."""
    length = F.length(word)

    def post(m: Column, part: int, longer: bool) -> Column:
        q = F.floor(m / 2).cast("int")
        cut = q if part == 0 else q + (1 if longer else 0)
        left, right = F.substring(word, F.lit(1), cut), F.substring(word, cut + 1, length)
        piece, rest = (left, right) if part == 0 else (right, left)
        return F.struct(m.cast("int").alias("m"), F.lit(part).alias("part"), piece.alias("piece"), rest.alias("rest"), F.lit(longer).alias("longer"))

    halves = F.array(post(length, 0, False), post(length, 1, False))
    grams = F.array(post(length - 1, 0, True), post(length - 1, 1, True))
    return F.when(length > least, F.concat(halves, grams)).otherwise(halves)


def near_words(words: DataFrame, least_chars: int = 6, crowd: int = CROWD) -> DataFrame:
    """(a, n_a, b, n_b): each pair of words one edit apart, once.

    A pair whose first halves agree is taken at the first half, any other at the second."""
    posted = (words.select("word", "n", F.explode(_postings(F.col("word"), least_chars)).alias("p")).select("word", "n", "p.*")
              .withColumn("key", F.xxhash64("m", "part", "piece")).drop("piece").checkpoint())
    crowded = posted.groupBy("key").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > crowd).select("key").checkpoint()
    hot = F.broadcast(crowded) if crowded.count() <= BROADCAST_ROWS else crowded
    few = posted.join(hot, "key", "left_anti")
    many = posted.join(hot, "key", "left_semi")
    # the rest without each code point in turn: two rests one edit apart share one of these
    left_out = F.expr("transform(sequence(0, length(rest) - 1), i -> struct(i as at, concat(substring(rest, 1, i), substring(rest, i + 2)) as body))")
    some = F.when(F.length("rest") > 0, left_out).otherwise(F.expr("array()").cast("array<struct<at:int,body:string>>"))
    at_place = F.transform(some, lambda v: F.xxhash64(F.col("key"), v["at"], v["body"]))
    anywhere = F.array_distinct(F.transform(some, lambda v: F.xxhash64(F.col("key"), F.lit(-1), v["body"])))
    as_is = F.array(F.xxhash64(F.col("key"), F.lit(-1), F.col("rest")))
    spread = many.select("word", "n", "m", "part", "longer", F.explode(
        F.when(F.col("longer"), anywhere).otherwise(F.concat(at_place, as_is))).alias("key"))
    meet = few.select("key", "word", "n", "m", "part", "longer").unionByName(spread.select("key", "word", "n", "m", "part", "longer"))
    a = meet.filter(~F.col("longer")).select("key", "m", "part", F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = meet.select("key", "longer", F.col("word").alias("b"), F.col("n").alias("n_b"))
    half = F.floor(F.col("m") / 2).cast("int")
    firsts_agree = F.substring("a", F.lit(1), half) == F.substring("b", F.lit(1), half)
    return (a.join(b, "key").filter(F.col("longer") | (F.col("a") < F.col("b")))
            .filter((F.col("part") == 0) == firsts_agree)
            .filter(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 6,
                      least_count: int = 5, every: int = 199, lead: int = 5, crowd: int = CROWD) -> DataFrame:
    """(word, form, root, n, n_near, form_n), a row per distinct word.

    ``form`` is the near word of greatest count (ties: the least by code point) if that is
    at least ``lead`` times the word's; ``root`` ends the chain of forms, which counts make
    finite.  No words give no rows.  Other columns are dropped, whatever their names."""
    if lead < 2 or least_chars < 4:
        raise ValueError("forms must lead, and words have two halves")
    ensure_checkpoint_dir(docs.sparkSession)
    words = word_counts(docs, id_col, text_col, least_chars, least_count, every).checkpoint()
    pairs = near_words(words, least_chars, crowd)
    sides = (pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m"))
             .unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m"))))
    best = sides.checkpoint().groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    leads = -F.col("best.m") >= lead * F.col("n")
    found = words.join(best, "word", "left").select(
        "word", F.when(leads, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(leads, -F.col("best.m")).alias("form_n")).checkpoint()
    step = found.filter("form is not null").select("word", F.col("form").alias("root")).checkpoint()
    while True:
        on = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if step.join(on, "root", "left_semi").isEmpty():
            break
        step = step.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")).checkpoint()
    return found.join(step, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
