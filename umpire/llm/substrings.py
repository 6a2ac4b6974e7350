"""Exact substring dedup: every byte inside a repeated 400-byte string goes.

**Anchors.**  The 32-byte gram of least hash in each ``length``-byte window is
the window's anchor.  Equal windows have the same anchor at the same offset, so
only windows around equal grams need to meet.  There is about one anchor per
185 bytes; a window that holds it starts at most 368 bytes before it, so its
context is the 368 bytes before and the 400 from it on, cut at the text's edges.

**Parts.**  The windows of an anchor fall into four parts by their distance to
it.  A part's windows together span its full string, and have its core in
common.  Occurrences with equal full strings are one class; a class of two or
more has all its part's windows repeated and covers the full string.  A window
that is repeated across classes lies in classes with equal cores.  Cores with one
class are done.  A gram's rows meet in one task; the rows of grams beyond ``hot``
occurrences go through combining aggregates and joins instead, which spread them.

**Columns.**  One fragment per remaining class goes to the collections
that ``column_order`` builds: all fragments are aligned at their anchors and, a
column per round from the right, one symbol of every fragment is inserted.  The
symbols in the order of the suffixes so far are that column's piece of the
collection's Burrows-Wheeler transform; a stable counting sort of it orders the
next suffixes, and common prefixes are updated from range minima of those
before.  After a round the suffixes of one column that share 400 symbols with a
neighbour are repeated windows.  Equal windows always lie in one column, so the
pieces of different columns need not be merged, and a round reads one piece and
replaces it.

A key that more than ``crowd`` classes share would be one task's group; its
windows are hashed instead, equal blocks of neighbouring windows are merged, and
the windows of what is left are counted by a combining aggregate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umpire.llm import text as X
from umpire.llm.graph import counted
from umpire.session import ensure_checkpoint_dir, shared_dir

U64 = np.uint64
GRAM = 32
PARTS = 4
KEY = ["doc", "mark"]
FULLS = [f"g{i}" for i in range(PARTS)]
ANCHOR = "doc long, mark long, places array<long>, gram long, cores long, " + ", ".join(f"{g} long" for g in FULLS)
MET = "doc long, mark long, place long, first int, last int, key long, crowded boolean"
SPAN = "doc long, mark long, start long, end long"


def parts(length: int) -> list[tuple[int, int]]:
    """Per part, the farthest and nearest window start left of the anchor."""
    cuts = np.linspace(0, length - GRAM + 1, PARTS + 1).astype(int)
    return [(int(hi) - 1, int(lo)) for lo, hi in zip(cuts[:-1], cuts[1:])][::-1]


def window_minima(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` neighbours, by block prefixes and suffixes."""
    n = len(key) - width + 1
    if n <= 0:
        return key[:0]
    blocks = -(-len(key) // width)
    padded = np.full(blocks * width, ~U64(0), dtype=U64)
    padded[:len(key)] = key
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def anchors(data: np.ndarray, off: np.ndarray, hasher: X.SpanHasher, length: int) -> np.ndarray:
    """Sorted positions of the anchors of all windows that lie inside one text."""
    if len(data) < length:
        return np.zeros(0, dtype=np.int64)
    at = np.arange(len(data) - GRAM + 1)
    bits = U64(max(1, int(len(at)).bit_length()))
    key = (hasher.spans(data, at, at + GRAM) >> bits << bits) | at.astype(U64)
    low = window_minima(key, length - GRAM + 1)
    sizes = np.diff(off)
    inside = np.zeros(len(low), dtype=bool)
    for s, n in zip(off[:-1][sizes >= length], sizes[sizes >= length]):
        inside[s:s + n - length + 1] = True
    return np.unique(low[inside] & ((U64(1) << bits) - U64(1))).astype(np.int64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _packed(at, left, right):
    """Place of an anchor in one number: position, bytes to its left and from it on."""
    return (at << 32) | (left << 16) | right


def _unpacked(place: np.ndarray):
    return place >> 32, (place >> 16) & 0xFFFF, place & 0xFFFF


def anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """A row per text and context of its anchors: their places, the gram, 16 hash bits
    of each part's core and the hash of each part's full string (cut at the text's
    edges).  A text's anchors that agree in all of these are one row."""
    reach = length - GRAM

    def run(batches):
        grams, hasher = X.SpanHasher(41), X.SpanHasher(43)
        for batch in batches:
            for lo, _, data, off in X.groups(batch.column(2), 1 << 20):
                at = anchors(data, off, grams, length)
                if len(at) == 0:
                    continue
                of = np.searchsorted(off, at, side="right") - 1
                s, e = off[of], off[of + 1]
                left, right = np.minimum(at - s, reach), np.minimum(e - at, length)
                cores, fulls = np.zeros(len(at), dtype=U64), []
                for i, (far, near) in enumerate(parts(length)):
                    core = hasher.spans(data, at - np.minimum(left, near), at + np.minimum(right, length - far))
                    cores |= (core >> U64(48)) << U64(16 * i)
                    a, b = np.minimum(left, far), np.minimum(right, length - near)
                    full = hasher.spans(data, at - a, at + b)
                    fulls.append(X.mix(full ^ X.mix(_packed(0, a, b).astype(U64))))
                gram, place = grams.spans(data, at, at + GRAM), _packed(at - s, left, right)
                order = np.lexsort((place, place & 0xFFFFFFFF, *fulls, cores, gram, of))
                columns = [x[order] for x in (of, gram, cores, *fulls, place & 0xFFFFFFFF)]
                new = np.flatnonzero(np.r_[True, np.any([x[1:] != x[:-1] for x in columns], axis=0)])
                rows = pa.array(lo + of[order][new])
                places = pa.ListArray.from_arrays(pa.array(np.r_[new, len(order)].astype(np.int32)), pa.array(place[order]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), places,
                     *[pa.array(_signed(x[new])) for x in columns[1:-1]]],
                    names=[c.split()[0] for c in ANCHOR.split(", ")])

    return docs.mapInArrow(run, ANCHOR)


def column_order(fragments: np.ndarray, starts: range, length: int) -> np.ndarray:
    """[fragment, start]: whether the ``length`` symbols of a fragment from a
    column in ``starts`` equal another fragment's from the same column.

    ``fragments`` is a matrix of aligned symbols; 0 is no symbol and equals
    nothing.  One round per column, from the last to the first of ``starts``.
    """
    m, columns = fragments.shape
    hit = np.zeros((m, len(starts)), dtype=bool)
    order = np.arange(m)
    common = np.zeros(m, dtype=np.int64)  # with the suffix before it in the order
    levels = max(1, int(m - 1).bit_length())
    for c in range(columns - 1, starts.start - 1, -1):
        piece = fragments[order, c]  # this column's piece of the transform
        move = np.argsort(piece, kind="stable")
        symbol = piece[move]
        # least common prefix between neighbours of the new order, in the old order
        tables = [common]
        for j in range(1, levels):
            before = tables[-1]
            tables.append(before if len(before) <= 1 << (j - 1) else
                          np.concatenate([before[:1 << (j - 1)], np.minimum(before[1 << (j - 1):], before[:-(1 << (j - 1))])]))
        table = np.stack(tables)
        a, b = move[:-1], move[1:]
        same = (symbol[1:] == symbol[:-1]) & (symbol[1:] != 0)
        span = np.where(same, b - a, 1)
        level = np.frexp(span.astype(float))[1] - 1
        low = np.minimum(table[level, np.where(same, b, 0)], table[level, np.where(same, a + (1 << level), 0)])
        order = order[move]
        common = np.zeros(m, dtype=np.int64)
        common[1:] = np.where(same, low + 1, 0)
        if c in starts:
            long = common >= length
            both = long.copy()
            both[:-1] |= long[1:]
            hit[order[both], c - starts.start] = True
    return hit


def _spans(hit: np.ndarray, first: np.ndarray, length: int):
    """Covered runs (row, start, end) of flagged window starts per row."""
    if hit.size == 0:
        return (np.zeros(0, np.int64),) * 3
    edge = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, a = np.nonzero(edge == 1)
    _, b = np.nonzero(edge == -1)
    return row, first[row] + a, first[row] + b - 1 + length


def _same_gram(found: DataFrame, length: int, crowd: int) -> DataFrame:
    """For grams whose rows meet in one task: runs of parts (first, last) whose full
    strings occur again, and, with a key, the fragments (part first) still wanted."""
    def group(rows: pa.Table):
        gram, lists = rows.column("gram").to_numpy().view(U64), rows.column("places").combine_chunks()
        times, starts = np.diff(lists.offsets.to_numpy()), lists.offsets.to_numpy()[:-1]
        place = lists.values.to_numpy()[starts]
        cores = rows.column("cores").to_numpy().view(U64)
        _, left, right = _unpacked(place)
        again = np.zeros((len(gram), PARTS + 2), dtype=np.int8)
        wanted = []
        for i, (far, near) in enumerate(parts(length)):
            has = np.flatnonzero((left >= near) & (right >= length - far))
            with np.errstate(over="ignore"):
                key = X.mix(gram[has] ^ X.mix((cores[has] >> U64(16 * i) & U64(0xFFFF)) + U64((i + 1) << 20)))
            full = rows.column(FULLS[i]).to_numpy()[has]
            order = np.lexsort((place[has], rows.column("mark").to_numpy()[has], full, key))
            key, full, has = key[order], full[order], has[order]
            other_key = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
            new = other_key | np.r_[True, full[1:] != full[:-1]] if len(key) else other_key
            number = np.cumsum(new) - 1
            again[has[np.bincount(number, times[has], minlength=1)[number] > 1] if len(has) else has, i + 1] = 1
            reps, of = has[new], np.cumsum(other_key)[new] - 1
            sharing = np.bincount(of, minlength=1)[of] if len(of) else of
            pick = sharing > 1
            wanted.append((reps[pick], np.full(pick.sum(), i), key[new][pick], sharing[pick] > crowd))
        edge = np.diff(again, axis=1)
        (row, first), (_, last) = np.nonzero(edge == 1), np.nonzero(edge == -1)
        n = times[row]
        every = lists.values.to_numpy()[np.repeat(starts[row] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        row, first, last = (np.repeat(x, n) for x in (row, first, last - 1))
        yield _tagged(rows, row, every, first, last, np.zeros(len(row), dtype=np.int64), np.zeros(len(row), bool), keyed=False)
        row, part, key, crowded = (np.concatenate(x) for x in zip(*wanted))
        yield _tagged(rows, row, place[row], part, part, _signed(key), crowded, keyed=True)

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows >= 20_000:
                gram = held.column("gram").to_numpy()
                cut = int(np.searchsorted(gram, gram[-1]))  # the last gram may go on
                if cut:
                    yield from group(held.slice(0, cut).combine_chunks())
                    held = held.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield from group(held.combine_chunks())

    return found.sortWithinPartitions("gram").mapInArrow(run, MET)


def _tagged(rows: pa.Table, row, place, first, last, key, crowded, keyed: bool):
    return pa.RecordBatch.from_arrays(
        [*[pa.array(rows.column(c).to_numpy()[row]) for c in KEY], pa.array(place), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
         pa.array(key, mask=np.full(len(key), not keyed)), pa.array(crowded)], names=[c.split()[0] for c in MET.split(", ")])


def _hot_gram(found: DataFrame, length: int, crowd: int) -> tuple[DataFrame, DataFrame]:
    """(doc, mark, spans) and the wanted fragments for the rows of hot grams, by
    aggregates and joins that spread."""
    context = ["gram", "cores", *FULLS, "shape"]
    rows = found.withColumn("shape", F.get("places", F.lit(0)).bitwiseAND((1 << 32) - 1))
    contexts = rows.groupBy(*context).agg(F.sum(F.size("places")).alias("times"),
                                          F.min(F.struct(*KEY, F.array_min("places").alias("place"))).alias("rep"))
    left, right = F.shiftright("shape", 16), F.col("shape").bitwiseAND(0xFFFF)
    each = contexts.select("*", F.explode(F.array(*[
        F.when((left >= near) & (right >= length - far),
               F.struct(F.lit(i).alias("part"), F.shiftrightunsigned("cores", 16 * i).bitwiseAND(0xFFFF).alias("core"), F.col(FULLS[i]).alias("full")))
        for i, (far, near) in enumerate(parts(length))])).alias("p")).filter("p is not null").select(*context, "times", "rep", "p.*")
    same = ["gram", "part", "core"]
    classes = each.groupBy(*same, "full").agg(F.sum("times").alias("all"), F.min("rep").alias("first"))
    runs = {mask: [(i, j) for i in range(PARTS) for j in range(i, PARTS)
                   if all(mask >> x & 1 for x in range(i, j + 1)) and not (i and mask >> i - 1 & 1) and not mask >> j + 1 & 1]
            for mask in range(1, 1 << PARTS)}
    lists = F.array(*[F.array(*[F.struct(F.lit(i).alias("first"), F.lit(j).alias("last")) for i, j in runs[m]]) for m in sorted(runs)])
    again = (each.join(classes.filter("all > 1").select(*same, "full"), [*same, "full"])
             .groupBy(*context).agg(F.bit_or(F.get(F.array(*[F.lit(1 << i) for i in range(PARTS)]), "part")).alias("mask")))
    covered = rows.join(again, context).select(*KEY, F.flatten(F.transform("places", lambda p: F.transform(
        F.get(lists, F.col("mask") - 1), lambda r: _bounds(p, r["first"], r["last"], length)))).alias("spans"))
    shared = classes.groupBy(*same).agg(F.count(F.lit(1)).alias("sharing")).filter("sharing > 1")
    wanted = classes.withColumnRenamed("first", "rep").join(shared, same).select(
        "rep.*", F.col("part").alias("first"), F.col("part").alias("last"), F.xxhash64(*same).alias("key"), (F.col("sharing") > crowd).alias("crowded"))
    return covered, wanted


def _bounds(place, first, last, length: int):
    """The bytes that the parts ``first`` to ``last`` of an anchor span."""
    at, left, right = F.shiftright(place, 32), F.shiftright(place, 16).bitwiseAND(0xFFFF), place.bitwiseAND(0xFFFF)
    ranges = F.array(*[F.struct(F.lit(far).alias("far"), F.lit(near).alias("near")) for far, near in parts(length)])
    return F.struct((at - F.least(left, F.get(ranges, first)["far"])).alias("start"),
                    (at + F.least(right, F.lit(length) - F.get(ranges, last)["near"])).alias("end"))


def _fragments(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(doc, mark, at, part, key, crowded, from, body): the bytes around each wanted
    place; ``from`` is the body's start relative to the anchor.  ``docs`` is read as
    a whole, so that its exchange is that of the last join."""
    ranges = parts(length)
    listed = (wanted.groupBy(*KEY).agg(F.collect_list(F.struct("place", "first", "key", "crowded")).alias("wanted"))
              .withColumnsRenamed({"doc": "_doc", "mark": "_mark"}))
    rows = docs.join(listed, (F.col("doc") == F.col("_doc")) & (F.col("mark") == F.col("_mark"))).select(*docs.columns, "wanted")
    at = [rows.columns.index(c) for c in ("doc", "mark", "body", "wanted")]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.binary())
    names = ["doc", "mark", "at", "part", "key", "crowded", "from", "body"]

    def run(batches):
        for batch in batches:
            out, size = [], 0
            for doc, mark, body, todo in zip(*(batch.column(i) for i in at)):
                doc, mark, raw = doc.as_py(), mark.as_py(), memoryview(body.as_buffer())
                for w in todo.as_py():
                    far, near = ranges[w["first"]]
                    place, left, right = _unpacked(w["place"])
                    lo, hi = min(left, far), min(right, length - near)
                    out.append((doc, mark, place, w["first"], w["key"], w["crowded"], -lo, bytes(raw[place - lo:place + hi])))
                    if len(out) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return rows.mapInArrow(run, "doc long, mark long, at long, part int, key long, crowded boolean, `from` int, body binary")


def _align(bodies: pa.Array, start: np.ndarray, far: int, columns: int) -> np.ndarray:
    out = np.zeros((len(start), columns), dtype=np.uint16)
    data, off = X.binary(bodies)
    size = np.diff(off)
    row = np.repeat(np.arange(len(start)), size)
    col = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start + far, size)
    out[row, col] = data[off[0]:off[-1]].astype(np.uint16) + 1
    return out


def _by_columns(fragments: DataFrame, length: int, most: int) -> DataFrame:
    """(doc, mark, start, end): repeated windows between fragments of one key.

    A collection is about ``most`` fragments, whole keys of one part; what is
    in it beside does no harm, since equal windows share a key."""
    ranges = parts(length)
    dealt = fragments.repartition("part", "key").sortWithinPartitions("part", "key")

    def collection(rows: pa.Table):
        far, near = ranges[rows.column("part")[0].as_py()]
        rows = rows.combine_chunks()
        matrix = _align(rows.column("body"), rows.column("from").to_numpy().astype(np.int64), far, far + length - near)
        hit = column_order(matrix, range(0, far - near + 1), length)
        row, s, e = _spans(hit, rows.column("at").to_numpy() - far, length)
        picked = rows.select(["doc", "mark"]).take(pa.array(row)).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [pa.array(picked.column(0).to_numpy()), pa.array(picked.column(1).to_numpy()), pa.array(s), pa.array(e)],
            names=["doc", "mark", "start", "end"])

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows > most:
                part, key = held.column("part").to_numpy(), held.column("key").to_numpy()
                new = np.flatnonzero((part[1:] != part[:-1]) | (key[1:] != key[:-1])) + 1
                if len(new) == 0:
                    break
                turn = np.flatnonzero(part != part[0])
                fits = new[new <= (min(most, turn[0]) if len(turn) else most)]
                cut = int(fits[-1] if len(fits) else new[0])
                yield collection(held.slice(0, cut))
                held = held.slice(cut)
        while held is not None and held.num_rows:
            part = held.column("part").to_numpy()
            turn = np.flatnonzero(part != part[0])
            cut = int(turn[0]) if len(turn) else held.num_rows
            yield collection(held.slice(0, cut))
            held = held.slice(cut)

    return dealt.mapInArrow(run, SPAN)


def _blocks(fragments: DataFrame, length: int, step: int, each: bool) -> DataFrame:
    """Blocks of ``step`` neighbouring windows of each fragment, cut at multiples of
    ``step`` from the anchor: the text position of the first window, its offset from
    the anchor, the number of windows, two hashes of the bytes they span together,
    and with ``each`` two hashes of each window, one window after the other."""
    ranges = np.array(parts(length))

    def run(batches):
        one, two = X.SpanHasher(53), X.SpanHasher(59)
        for batch in batches:
            for cut in range(0, batch.num_rows, 2048):
                rows = batch.slice(cut, 2048)
                at, part, first = (rows.column(i).to_numpy().astype(np.int64) for i in (2, 3, 6))
                data, off = X.binary(rows.column(7))
                data, off = data[off[0]:off[-1]], off - off[0]
                far, near = ranges[part].T
                low = np.maximum(0, -far - first)
                n = np.maximum(0, np.minimum(np.diff(off) - length, -near - first) - low + 1)
                row = np.repeat(np.arange(len(n)), n)
                if len(row) == 0:
                    continue
                s = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + low[row]
                offset, start = s + first[row], s + off[row]
                new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (offset[1:] // step != offset[:-1] // step)])
                ends = np.r_[new[1:], len(row)]
                windows = np.stack([h.spans(data, start, start + length) for h in (one, two)], axis=1) if each else np.zeros((0, 2), dtype=U64)
                sizes = np.r_[new, len(row)] if each else np.zeros(len(new) + 1)
                whole = [h.spans(data, start[new], start[ends - 1] + length) for h in (one, two)]
                taken = rows.select(["doc", "mark"]).take(pa.array(row[new]))
                yield pa.RecordBatch.from_arrays(
                    [taken.column(0), taken.column(1), pa.array(at[row[new]] + offset[new]), pa.array(offset[new].astype(np.int32)),
                     pa.array((ends - new).astype(np.int32)), *[pa.array(_signed(h)) for h in whole],
                     pa.ListArray.from_arrays(pa.array((2 * sizes).astype(np.int32)), pa.array(_signed(windows.ravel())))],
                    names=["doc", "mark", "start", "offset", "n", "h1", "h2", "windows"])

    return fragments.mapInArrow(run, "doc long, mark long, start long, offset int, n int, h1 long, h2 long, windows array<long>")


def _by_windows(fragments: DataFrame, length: int, step: int = 16) -> DataFrame:
    """(doc, mark, spans) for crowded keys, by aggregates and joins that spread.

    Fragments' blocks of windows that are equal as a whole are one kind; a kind of
    two or more has all its windows repeated.  Windows are counted once per kind,
    and a kind hands back one bit per repeated window.  All three readers of the kinds
    take the same columns, so one exchange serves them."""
    kind, same = ["offset", "n", "h1", "h2"], ["place", "w1", "w2"]
    never_null = " and ".join(f"{c} is not null" for c in kind)  # said here, joins add it to no reader alone
    blocks = _blocks(fragments, length, step, each=True).filter(never_null)
    kinds = blocks.groupBy(*kind).agg(F.count(F.lit(1)).alias("times"), F.first("windows").alias("windows"))
    windows = kinds.select(*kind, "times", "windows", F.explode(F.sequence(F.lit(0), F.shiftright(F.size("windows"), 1) - 1)).alias("i")).select(
        *kind, "times", "i", (F.col("offset") + F.col("i")).alias("place"),
        F.get("windows", 2 * F.col("i")).alias("w1"), F.get("windows", 2 * F.col("i") + 1).alias("w2"))
    often = windows.groupBy(*same).agg(F.sum("times").alias("all")).filter("all > 1").select(*same)
    bit = F.get(F.array(*[F.lit(1 << i) for i in range(step)]), "i")
    some = windows.filter("times = 1").join(often, same).groupBy(*kind).agg(F.bit_or(bit).alias("mask"))
    every = windows.filter("times > 1").groupBy(*kind).agg(F.bit_or(bit).alias("mask"))
    found = _blocks(fragments, length, step, each=False).select(*KEY, "start", *kind).join(some.unionByName(every), kind)
    mask = F.col("mask")

    def ones(bits):
        return F.filter(F.sequence(F.lit(0), F.lit(step - 1)), lambda i: F.bit_get(bits, i) == 1)

    first, last = (ones(mask.bitwiseAND(F.bitwise_not(moved(mask, 1)))) for moved in (F.shiftleft, F.shiftright))
    return found.select(*KEY, F.transform(F.arrays_zip(first.alias("first"), last.alias("last")), lambda r: F.struct(
        (F.col("start") + r["first"]).alias("start"), (F.col("start") + r["last"] + length).alias("end"))).alias("spans"))


def repeated_spans(docs: DataFrame, length: int, hot: int, crowd: int, most: int) -> DataFrame:
    """(doc, mark, spans): arrays of byte spans covered by repeated strings; they overlap."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "substrings")
    anchor_rows(docs.select("doc", "mark", "body"), length).write.parquet(f"{folder}/anchors")
    found = spark.read.parquet(f"{folder}/anchors")
    crowds = found.groupBy("gram").agg(F.sum(F.size("places")).alias("times")).filter(F.col("times") > hot).select("gram").checkpoint()
    crowds = counted(crowds)  # at most one in ``hot`` places
    # dealt by another expression than the join's: its own exchange, which no rewriting of
    # the join while the query runs (broadcast with local reads, splits) can take away
    calm = found.join(crowds, "gram", "left_anti").repartition(F.xxhash64("gram"))
    _same_gram(calm, length, crowd).write.parquet(f"{folder}/calm")
    covered, more = _hot_gram(found.join(crowds, "gram", "left_semi"), length, crowd)
    more.write.parquet(f"{folder}/more")
    covered.write.parquet(f"{folder}/covered")
    calm, more, covered = (spark.read.parquet(f"{folder}/{name}") for name in ("calm", "more", "covered"))
    wanted = calm.filter("key is not null").unionByName(more)
    whole = calm.filter("key is null").select(*KEY, F.array(_bounds(F.col("place"), F.col("first"), F.col("last"), length)).alias("spans"))
    fragments = _fragments(docs, wanted, length)
    runs = _by_columns(fragments.filter("not crowded"), length, most).select(*KEY, F.array(F.struct("start", "end")).alias("spans"))
    if not wanted.filter("crowded").isEmpty():
        runs = runs.unionByName(_by_windows(fragments.filter("crowded"), length))
    return whole.unionByName(covered).unionByName(runs)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                     hot: int = 2000, crowd: int = 512, most: int = 4096) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the
    remaining bytes) and spans (start, end of each maximal removed run).

    Texts are UTF-8 bytes; a null one is empty.  Each byte covered by a string
    of ``length`` bytes that also starts elsewhere, in any text or the same,
    goes; matches do not cross texts and may overlap; all are judged on the
    input.  Rows that repeat an id are texts of their own; rows that repeat id
    and text repeat every string in them.  Extra columns are ignored.
    ``length`` must exceed 64.
    """
    if length <= 2 * GRAM:
        raise ValueError("length must exceed 64")
    ensure_checkpoint_dir(docs.sparkSession)
    body = F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b""))
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), body.alias("body"))
            .withColumn("mark", F.xxhash64("id", "body")).withColumn("doc", F.coalesce("id", F.lit(0))))
    found = repeated_spans(rows, length, hot, crowd, most)
    listed = (found.groupBy(*KEY).agg(F.flatten(F.collect_list("spans")).alias("found"))
              .withColumnsRenamed({"doc": "_doc", "mark": "_mark"}))
    joined = (rows.join(listed, (F.col("doc") == F.col("_doc")) & (F.col("mark") == F.col("_mark")), "left")
              .select("id", "body", "found"))  # by the exchange that gave the fragments

    def cut(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                removed, kept, runs = [], [], []
                for body, spans in zip(part.column(1), part.column(2)):
                    raw = memoryview(body.as_buffer())
                    joined_spans = _union(spans)
                    at, left = 0, []
                    for s, e in joined_spans:
                        left.append(raw[at:s])
                        at = e
                    left.append(raw[at:])
                    kept.append(b"".join(left))
                    removed.append(len(raw) - len(kept[-1]))
                    runs.append([{"start": s, "end": e} for s, e in joined_spans])
                size = [len(k) + r for k, r in zip(kept, removed)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array([len(r) for r in runs], pa.int64()), pa.array(kept, pa.binary()), pa.array(runs, kind)],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, "
                                  "spans array<struct<start: long, end: long>>")


def _union(spans: pa.Scalar) -> list[tuple[int, int]]:
    """Maximal runs of a list of spans; touching ones are one run."""
    if not spans.is_valid or len(spans.values) == 0:
        return []
    s = spans.values.field("start").to_numpy()
    e = spans.values.field("end").to_numpy()
    order = np.argsort(s, kind="stable")
    s, reach = s[order], np.maximum.accumulate(e[order])
    new = np.flatnonzero(np.r_[True, s[1:] > reach[:-1]])
    return list(zip(s[new].tolist(), reach[np.r_[new[1:] - 1, len(s) - 1]].tolist()))
