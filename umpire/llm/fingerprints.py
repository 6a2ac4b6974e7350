"""Similarity digests of whole texts from their improbable byte windows.

* A text's features are its byte windows.  Each has an entropy level, 0 to 1000.
* A level's rank is its rarity: levels that fewer windows of the whole corpus hold
  come first (``level_ranks``, a table of at most 1,001 rows).
* Around each window lie ``span`` neighbourhoods of ``span`` windows; a
  neighbourhood votes for its rarest window, leftmost among equals.  Windows with
  ``least`` votes are selected.  A text's rarest window wins all its
  neighbourhoods, so every text but the empty one has a feature.
* Distinct selected features, in order of first place, go into a chain of Bloom
  filters of 2,048 bits, ``per`` features each, five bits a feature.
* Two filters are as alike as their common bits exceed the bits that chance would
  share, over the most that they could; excess up to ``cut`` of that counts as
  nothing.  A chain's likeness is the mean, by features, of the best match of each
  filter of the chain with fewer features.

Texts are read once to count levels and once, dealt by ranges of the id, to meet
their neighbours; a range's first document is also sent to the range before it.
"""

from __future__ import annotations

import base64
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umpire.llm.text import U64, groups, mix

LEVELS = 1001
BITS = 2048
SLICE = 4 << 20
_POS = 40


class Shape:
    """The digest's fixed parameters."""

    def __init__(self, window: int = 16, span: int = 16, least: int = 4, per: int = 160, weak: int = 100, cut: float = 0.1):
        if window % 8 or span & (span - 1) or not 1 <= least <= span:
            raise ValueError("window must be a multiple of 8, span a power of two, least within span")
        self.window, self.span, self.least, self.per, self.weak, self.cut = window, span, least, per, weak, cut
        count = np.arange(window + 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.term = np.nan_to_num(np.round(count * np.log2(count) * (1 << 20))).astype(np.int64)

    def levels(self, data: np.ndarray) -> np.ndarray:
        """Entropy level of the window at every place of a byte buffer.

        Sliding by one byte takes the first byte out and the next one in; how often each
        stands among its ``window - 1`` neighbours is summed from shifted comparisons."""
        w, n = self.window, len(data)
        if n < w:
            return np.zeros(0, dtype=np.int64)
        before, after = np.zeros(n, dtype=np.uint8), np.zeros(n, dtype=np.uint8)
        for j in range(1, w):
            same = (data[j:] == data[:-j]).view(np.uint8)
            before[j:] += same
            after[:n - j] += same
        into, out = np.diff(self.term), -np.diff(self.term)
        total = np.empty(n - w + 1, dtype=np.int64)
        total[0] = self.term[np.bincount(data[:w], minlength=256)].sum()
        total[1:] = into[before[w:]] + out[after[:n - w]]
        np.cumsum(total, out=total)
        return LEVELS - 1 - (LEVELS - 1) * total // self.term[w]

    def votes(self, levels: np.ndarray, off: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start of every window of every text, and its votes."""
        w, span = self.window, self.span
        size = np.diff(off)
        held = np.where(size >= w, size - w + 1, np.minimum(size, 1))
        first = np.concatenate([[0], np.cumsum(held)])
        text = np.repeat(np.arange(len(size)), held)
        start = off[text] + np.arange(first[-1]) - first[text]
        if len(start) == 0:
            return start, start
        whole = size[text] >= w
        own = np.zeros(len(start), dtype=np.int64)
        own[whole] = rank[levels[start[whole]]]
        # texts stand apart by span - 1 places that never win, so neighbourhoods meet one text
        place = np.arange(len(start)) + (text + 1) * (span - 1)
        key = np.full(place[-1] + span, np.iinfo(np.int64).max)
        key[place] = (own << _POS) | np.arange(len(start))
        step = 1
        while step < span:
            key = np.minimum(key[:-step], key[step:])
            step *= 2
        won = key[key != np.iinfo(np.int64).max] & ((1 << _POS) - 1)
        return start, np.bincount(won, minlength=len(start))

    def selected(self, data: np.ndarray, off: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of each selected window; a long text goes slice by slice, and the
        slices overlap by what the votes of their own windows hang on."""
        w, span = self.window, self.span
        if len(data) <= SLICE:
            start, votes = self.votes(self.levels(data), off, rank)
            start = start[votes >= self.least]
        else:
            found = []
            for t in np.flatnonzero(np.diff(off)):
                lo, hi = off[t], off[t + 1]
                for a in range(lo, hi, SLICE):
                    b = min(a + SLICE, hi)
                    left, right = max(lo, a - span + 1), min(hi, b + w + span - 2)
                    part = data[left:right]
                    s, votes = self.votes(self.levels(part), np.array([0, right - left]), rank)
                    s = s[votes >= self.least] + left
                    found.append(s[(s >= a) & (s < b)])
            start = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
        text = np.searchsorted(off, start, side="right") - 1
        return start, np.minimum(start + w, off[text + 1])

    def hashes(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of each window; a shorter one is a whole text, filled up with zeros."""
        w = self.window
        at = start[:, None] + np.arange(w)
        inside = at < end[:, None]
        body = np.where(inside, data[np.where(inside, at, 0)], 0).astype(np.uint8)
        out = (end - start).astype(U64)
        with np.errstate(over="ignore"):
            for word in np.ascontiguousarray(body).view("<u8").T:
                out = mix(out * U64(0x9E3779B97F4A7C15) + word)
        return out

    def digests(self, column: pa.Array, rank: np.ndarray) -> list["Digest"]:
        """The digest of every text of a column, in bounded runs of texts."""
        out = []
        for _, _, data, off in groups(column):
            start, end = self.selected(data, off, rank)
            text = np.searchsorted(off, start, side="right") - 1
            h = self.hashes(data, start, end) if len(start) else np.zeros(0, dtype=U64)
            order = np.lexsort((start, h, text))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (np.diff(h[order]) != 0) | (np.diff(text[order]) != 0)
            keep = np.sort(order[new])
            text, h = text[keep], h[keep]
            held = np.bincount(text, minlength=len(off) - 1)
            first = np.concatenate([[0], np.cumsum(held)])
            chain = -(-held // self.per)
            base = np.concatenate([[0], np.cumsum(chain)])
            row = base[text] + (np.arange(len(text)) - first[text]) // self.per
            bits = np.zeros((base[-1], BITS), dtype=bool)
            for k in range(5):
                bits[row, ((h >> U64(11 * k)) & U64(BITS - 1)).astype(np.int64)] = True
            features = np.bincount(row, minlength=base[-1])
            packed = np.packbits(bits, axis=1)
            out += [Digest(packed[a:b], features[a:b]) for a, b in zip(base[:-1], base[1:])]
        return out

    def likeness(self, a: "Digest", b: "Digest") -> float:
        """0 to 1; equal digests, two empty ones included, are alike by 1."""
        if a.features.sum() > b.features.sum():
            a, b = b, a
        if len(a.features) == 0 or len(b.features) == 0:
            return float(len(a.features) == len(b.features))
        if np.array_equal(a.bits, b.bits):
            return 1.0
        best = np.zeros(len(a.features))
        for lo in range(0, len(a.features), 1024):
            left = np.unpackbits(a.bits[lo:lo + 1024], axis=1).astype(np.float32)
            na = left.sum(axis=1, dtype=np.float64)[:, None]
            for at in range(0, len(b.features), 1024):
                right = np.unpackbits(b.bits[at:at + 1024], axis=1).astype(np.float32)
                nb = right.sum(axis=1, dtype=np.float64)[None, :]
                chance, most = na * nb / BITS, np.minimum(na, nb)
                floor = chance + self.cut * (most - chance)
                score = ((left @ right.T).astype(np.float64) - floor) / np.maximum(most - floor, 1e-9)
                best[lo:lo + 1024] = np.maximum(best[lo:lo + 1024], score.max(axis=1))
        return float(np.clip(np.average(np.clip(best, 0, 1), weights=a.features), 0, 1))


class Digest:
    """A chain of Bloom filters and the number of features in each."""

    def __init__(self, bits: np.ndarray, features: np.ndarray):
        self.bits, self.features = bits, features

    def __str__(self) -> str:
        return ";".join(f"{n}:{base64.b64encode(row.tobytes()).decode()}" for n, row in zip(self.features.tolist(), self.bits))


def parse(fingerprint: str) -> Digest:
    """The digest that a fingerprint string names."""
    parts = [p.split(":") for p in fingerprint.split(";") if p]
    bits = np.array([list(base64.b64decode(b)) for _, b in parts], dtype=np.uint8).reshape(len(parts), BITS // 8)
    return Digest(bits, np.array([int(n) for n, _ in parts], dtype=np.int64))


def level_ranks(docs: DataFrame, text_col: str = "text", shape: Shape | None = None) -> np.ndarray:
    """Rank of each entropy level over the windows of all texts, rarest first.

    Levels below ``weak`` (runs of few different bytes) rank last; among levels held
    equally often the higher comes first."""
    shape = shape or Shape()

    def count(batches):
        total = np.zeros(LEVELS, dtype=np.int64)
        for batch in batches:
            for _, _, data, off in groups(batch.column(0)):
                for lo in range(0, len(data), SLICE):
                    levels = shape.levels(data[lo:lo + SLICE + shape.window - 1])
                    cut = np.zeros(len(levels) + 1, dtype=np.int64)  # windows over a text's end are not counted
                    ends = off[1:-1] - lo
                    np.add.at(cut, np.clip(ends - shape.window + 1, 0, len(levels)), 1)
                    np.add.at(cut, np.clip(ends, 0, len(levels)), -1)
                    total += np.bincount(levels[np.cumsum(cut[:-1]) == 0], minlength=LEVELS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["level", "n"])

    rows = (docs.select(F.col(text_col).cast("binary")).mapInArrow(count, "level int, n long")
            .groupBy("level").agg(F.sum("n").alias("n")).collect())
    held = np.zeros(LEVELS, dtype=np.int64)
    for r in rows:
        held[r["level"]] = r["n"]
    level = np.arange(LEVELS)
    order = np.lexsort((-level, held, level < shape.weak))
    rank = np.empty(LEVELS, dtype=np.int64)
    rank[order] = level
    return rank


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shape: Shape | None = None) -> DataFrame:
    """(id, fingerprint) of every row, without a shuffle of texts.

    A null text is empty; an empty text's fingerprint is the empty string.  Other
    columns are dropped, whatever their names."""
    shape = shape or Shape()
    rank = level_ranks(docs, text_col, shape)
    kind = docs.schema[id_col].dataType

    def run(batches):
        for batch in batches:
            made = [str(d) for d in shape.digests(batch.column(1), rank)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["id", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind.simpleString()}, fingerprint string").withColumnRenamed("id", id_col)


def id_ranges(docs: DataFrame, id_col: str, ranges: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Cuts of the id into about equal ranges, and (range, its greatest id) of each range
    that holds rows, by greatest id first.  Reads the ids alone."""
    ids = docs.select(F.col(id_col).alias("id"))
    at = [i / ranges for i in range(1, ranges)] or [0.5]
    cuts = ids.agg(F.percentile_approx("id", at, F.lit(20 * ranges)).alias("q")).first()["q"] or []
    cuts = sorted(set(cuts))
    top = ids.groupBy(_range_of(F.col("id"), cuts).alias("r")).agg(F.max("id").alias("id")).collect()
    return cuts, sorted(((r["r"], r["id"]) for r in top), reverse=True)


def _range_of(column, cuts: list[int]):
    """0 for a null id, else 1 + the number of cuts below the id, counted in two steps of
    about the root of their number."""
    if not cuts:
        return F.when(column.isNull(), F.lit(0)).otherwise(F.lit(1))
    step = math.isqrt(len(cuts)) + 1
    blocks = [F.array(*[F.lit(c).cast("long") for c in cuts[i:i + step]]) for i in range(0, len(cuts), step)]
    heads = F.array(*[F.lit(c).cast("long") for c in cuts[::step]])
    block = F.size(F.filter(heads, lambda c: c < column))
    inside = F.size(F.filter(F.element_at(F.array(*blocks), block), lambda c: c < column))
    below = F.when(block == 0, F.lit(0)).otherwise((block - 1) * step + inside)
    return F.when(column.isNull(), F.lit(0)).otherwise(below + 1).cast("int")


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shape: Shape | None = None,
                  ranges: int | None = None) -> DataFrame:
    """Each text's digest against that of its edited text and of the next text.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next).  The next document is that of the next smaller id; nulls come last and
    the last is followed by the first.  Rows of one id are ordered by a hash of their
    text.  The edited text keeps the first half and takes, for the last ``n_chars // 2``
    code points, as many of the next text's first, or all it has.  A null text is empty.
    A single row is its own next.  Other columns are dropped, whatever their names."""
    shape = shape or Shape()
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rank = level_ranks(docs, text_col, shape)
    cuts, tops = id_ranges(docs, id_col, ranges or 4 * parts)
    # the first document of each range follows the last one of the range before it
    before = {tops[i][0]: tops[i - 1][0] for i in range(len(tops))}
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("r", _range_of(F.col("id"), cuts))
    if tops:
        # by range, so that a row finds its own in one step
        greatest = dict(tops)
        places = range(max(greatest) + 1)
        first = F.get(F.array(*[F.lit(greatest.get(r)).cast("long") for r in places]), F.col("r"))
        known = F.get(F.array(*[F.lit(before.get(r)).cast("int") for r in places]), F.col("r"))
        leads = F.col("id").isNull() | F.coalesce(F.col("id") == first, F.lit(False))
        spot = F.array(F.struct(F.col("r").alias("r"), F.lit(False).alias("lead")))
        more = F.array(F.struct(known.alias("r"), F.lit(True).alias("lead")))
        rows = rows.select("id", "text", F.explode(F.when(leads, F.concat(spot, more)).otherwise(spot)).alias("to")).select("to.*", "id", "text")
    else:
        rows = rows.select("r", F.lit(False).alias("lead"), "id", "text")
    dealt = rows.repartition(parts, "r").sortWithinPartitions("r", "lead", F.col("id").desc_nulls_last(), F.xxhash64("text"))

    def run(batches):
        held = None  # the row whose next is not read yet: (r, id, text, digest)
        for batch in batches:
            for lo, hi, _, _ in groups(batch.column(3)):
                part = batch.slice(lo, hi - lo)
                rs, leads, ids = (part.column(i).to_pylist() for i in range(3))
                digest = shape.digests(part.column(3), rank)
                texts = part.column(3).to_pylist()
                pairs = []
                for row in zip(rs, ids, texts, digest, leads):
                    if held is not None and held[0] == row[0]:
                        pairs.append((held, row))
                    held = None if row[4] else row
                if pairs:
                    yield _compare(shape, rank, pairs)

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                 "near_edited double, near_next double")


def _compare(shape: Shape, rank: np.ndarray, pairs: list) -> pa.RecordBatch:
    edited = []
    for (_, _, text, _, _), (_, _, follows, _, _) in pairs:
        half = len(text) // 2
        edited.append(text[:len(text) - half] + follows[:half])
    made = shape.digests(pa.array(edited, pa.large_string()), rank)
    own = [(p[0][3], p[1][3]) for p in pairs]
    columns = [
        pa.array([p[0][1] for p in pairs], pa.int64()),
        pa.array([len(p[0][2]) for p in pairs], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array([str(d) for d, _ in own], pa.string()),
        pa.array([str(d) for d in made], pa.string()),
        pa.array([shape.likeness(d, e) for (d, _), e in zip(own, made)], pa.float64()),
        pa.array([shape.likeness(d, n) for d, n in own], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
