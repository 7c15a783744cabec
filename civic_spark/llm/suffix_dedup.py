"""Removal of byte strings that occur more than once, by suffix arrays of the places where texts can agree.

Every byte covered by a ``SPAN``-byte string that also starts anywhere else (same document included) is removed; strings
are judged on the input and never cross documents.

1. Anchors.  In every ``SPAN``-byte string the ``GRAM``-byte substrings with the least hash are its anchors, so two
   equal strings have the same anchors at the same offsets.  A text has about one anchor per 85 bytes.  One pass over
   the texts writes (anchor hash, hash of its surroundings, document, position).  The surroundings of an anchor are
   all ``SPAN``-byte strings around it: SPAN - GRAM bytes before it, SPAN bytes from it on.
2. Only anchors that occur twice or more go on.  Places with equal surroundings repeat as a whole, by counting.
3. The other places of an anchor agree with each other in part.  One place per distinct surrounding, as bytes, comes
   to a task with the others of its anchor.  There the surroundings, which are aligned at the anchor, are cut where any
   two of them part (left and right of the anchor), which turns each into a short sequence of symbols such that two
   places share bytes exactly where they share symbols.  The suffixes of all sequences are sorted by linear grouping
   (``gsaca``); the common prefix of a suffix with its neighbours in that order is the longest agreement to the right
   for a given agreement to the left, and those of ``SPAN`` bytes or more are repeated.
4. An anchor with more than ``MOST`` distinct surroundings (a passage that very many documents share) is split: the
   strings around it by their offset, halves of the range at a time, and each half by the bytes that all its strings
   have in common, until groups are small or their strings equal.  No string is left out, and no task holds a whole
   group.
5. Repeated intervals meet their documents, are united, and the remaining bytes are hashed.

Anchors and surroundings are named by 128 bits together; equal names are taken as equal bytes in step 2, and groups in
step 3 are compared as bytes.

Defined results: a null text has no bytes; texts shorter than ``SPAN`` lose nothing; rows that repeat an id, or are
repeated in full, count as documents of their own.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civic_spark.llm.arrow_text import _BYTE, POWERS, mix, text_buffers
from civic_spark.llm.gsaca import common_prefixes, suffix_order
from civic_spark.llm.shared import Scratch

SPAN, GRAM = 200, 32
BEFORE = SPAN - GRAM
WINDOW = SPAN - GRAM + 1
#: Bytes whose anchors are found at a time.
SEGMENT = 1 << 20
#: Distinct surroundings that one task sorts together.
MOST = 64
#: Symbols sorted in one suffix array; a task goes through its groups in such portions.
PORTION = 100_000
KEY = ["doc", "tkey"]
NO_ID = -(1 << 63)
ANCHORS = "doc long, tkey long, anchor long, around long, place long"


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:len(x) - have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def anchors(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, hashes, hashes of surroundings) of the anchors of one text."""
    n, found = len(text), []
    for at in range(0, max(n - SPAN + 1, 0), SEGMENT):
        # Strings that start in [at, at + SEGMENT), and the surroundings of their anchors.
        lo = max(0, at - BEFORE)
        part = text[lo:at + SEGMENT + 2 * SPAN]
        POWERS.upto(len(part) + 1)
        run = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * POWERS.up[:len(part)], out=run[1:])
        first = at - lo
        last = min(len(part), first + SEGMENT - 1 + SPAN)
        grams = mix((run[first + GRAM:last + 1] - run[first:last + 1 - GRAM]) * POWERS.down[first:last + 1 - GRAM])
        least = _sliding_min(grams, WINDOW)
        # A gram is an anchor if it is the least of a window that holds it: if the greatest such least is its own.
        edge = np.zeros(WINDOW - 1, np.uint64)
        best = ~_sliding_min(~np.concatenate((edge, least, edge)), WINDOW)
        pos = np.flatnonzero(best == grams) + first
        left, right = np.maximum(pos + lo - BEFORE, 0) - lo, np.minimum(pos + lo + SPAN, n) - lo
        size = ((pos - left) * 1024 + (right - pos)).astype(np.uint64)
        around = mix((run[right] - run[left]) * POWERS.down[left] + mix(size))
        found.append((pos + lo, grams[pos - first], around))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    pos, gram, around = (np.concatenate(x) for x in zip(*found, strict=True))
    _, one = np.unique(pos, return_index=True)
    return pos[one], gram[one], around[one]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in ANCHORS.split(", ")]
    for batch in batches:
        data, at = text_buffers(batch.column(2))
        doc, tkey = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        held, rows = 0, []

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], names=names)

        for k in range(len(at) - 1):
            pos, gram, around = anchors(data[at[k]:at[k + 1]])
            if not len(pos):
                continue
            size = int(at[k + 1] - at[k])
            rows.append((np.full(len(pos), doc[k]), np.full(len(pos), tkey[k]), gram.view(np.int64), around.view(np.int64),
                         pos << 16 | np.minimum(pos, BEFORE) << 8 | np.minimum(size - pos, SPAN)))
            held += len(pos)
            if held > 50_000:
                yield table(rows)
                held, rows = 0, []
        if rows:
            yield table(rows)


#: A place in one number: position, bytes before it and from it on that its surroundings hold (each below 256).
PLACE = {"pos": "shiftright(place, 16)", "l": "cast(shiftright(place, 8) & 255 as int)", "r": "cast(place & 255 as int)"}


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed texts: they are shuffled whole."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        data, at = text_buffers(batch.column(2))
        packed = [press.compress(data[at[k]:at[k + 1]].tobytes()) for k in range(len(at) - 1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=[*KEY, "packed"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the surroundings asked for, per packed text."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for k in range(batch.num_rows):
            one = batch.slice(k, 1)
            text = unpack.decompress(one.column(2)[0].as_buffer().to_pybytes())
            wanted = one.column(3).flatten()
            place = wanted.field("place").to_numpy()
            pos, l, r = place >> 16, place >> 8 & 255, place & 255
            cut = [text[p - a:p + b] for p, a, b in zip(pos, l, r, strict=True)]
            n = len(cut)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(one.column(c).to_numpy(), n)) for c in (0, 1)]
                + [wanted.field(name) for name in ("anchor", "group_size", "times")]
                + [pa.array(pos), pa.array(l.astype(np.int32)), pa.array(r.astype(np.int32)), pa.array(cut, pa.binary())],
                names=[*KEY, "anchor", "group_size", "times", "pos", "l", "r", "bytes"])


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("tkey"), text.alias("text"))


class _Portion:
    """Groups of aligned surroundings as symbol sequences in one suffix array."""

    def __init__(self) -> None:
        self.symbols: list[int] = []
        self.starts: list[tuple[int, int, int]] = []  # where a suffix starts, whose it is, bytes of agreement before the anchor
        self.rights: dict[int, tuple[int, list[int]]] = {}  # row: (place of its anchor symbol, depths to the right)
        self.rows: list = []
        self.next = 1

    def add(self, left: list[bytes], right: list[bytes], rows: list) -> None:
        """One group: texts before the anchor (reversed) and from it on, and what names each."""
        base, n = len(self.rows), len(rows)
        self.rows.extend(rows)
        levels_l, levels_r = _levels(left), _levels(right)
        core, self.next = self.next, self.next + 1
        for k in range(n):
            lefts, rights = levels_l[k], levels_r[k]
            for j in range(len(lefts) - 1, -1, -1):
                self.starts.append((len(self.symbols), base + k, lefts[j][0]))
                self.symbols.append(self.next + lefts[j][1])
            self.starts.append((len(self.symbols), base + k, 0))
            self.rights[base + k] = (len(self.symbols), [d for d, _ in rights])
            self.symbols.append(core)
            self.symbols.extend(-self.next - 1 - node for _, node in rights)
            self.symbols.append(0)
        self.next += 1 + max([0, *(node for x in (levels_l, levels_r) for own in x for _, node in own)])

    def agreements(self) -> Iterator[tuple[object, int, int]]:
        """(row, bytes before the anchor, bytes from it on) of every longest agreement with another row."""
        if not self.rows:
            return
        # Ends tell rows apart: each gets a symbol of its own, below all others.
        least = -(1 << 50)
        seq = [least - k if s == 0 else s for k, s in enumerate(self.symbols)]
        order = suffix_order(seq)
        common = common_prefixes(seq, order)
        best = [0] * len(seq)
        for k, s in enumerate(order):
            best[s] = max(common[k], common[k + 1] if k + 1 < len(order) else 0)
        for at, row, before in self.starts:
            core, depths = self.rights[row]
            shared = best[at] - (core - at) - 1
            if shared >= 0:
                yield self.rows[row], before, depths[shared - 1] if shared else 0


def _levels(texts: list[bytes]) -> list[list[tuple[int, int]]]:
    """Per text, the (depth, node) at which it still agrees with another one: depths where any two of all part."""
    order = sorted(range(len(texts)), key=texts.__getitem__)
    common = [0] * (len(texts) + 1)
    for k in range(1, len(order)):
        common[k] = _agree(texts[order[k - 1]], texts[order[k]])
    depths = sorted({c for c in common if c})
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    node = [0] * len(depths)
    last = 0
    for k, t in enumerate(order):
        most = max(common[k], common[k + 1])
        for j in range(bisect_right(depths, most)):
            if common[k] < depths[j] or not k:
                last += 1
                node[j] = last
            out[t].append((depths[j], node[j]))
    return out


def _agree(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:  # a[:lo] agrees, a[:hi] doesn't
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


INTERVALS = "doc long, tkey long, start long, stop long"


def _agreements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated intervals of places, grouped by ``gid`` (rows of a group follow each other)."""
    portion, group, own = _Portion(), None, []

    def flush() -> Iterator[pa.RecordBatch]:
        # All agreements of a place hold its anchor, so their union is one interval.
        reach: dict = {}
        for place, a, b in portion.agreements():
            if place[3] == 1 and a + b >= SPAN:
                a0, b0 = reach.get(place, (0, 0))
                reach[place] = max(a, a0), max(b, b0)
        got = [(d, t, p - a, p + b) for (d, t, p, _), (a, b) in reach.items()]
        if got:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*got, strict=True)],
                                             names=["doc", "tkey", "start", "stop"])

    def close() -> None:
        if len(own) > 1:
            portion.add([x[2][:x[1]][::-1] for x in own], [x[2][x[1]:] for x in own], [x[0] for x in own])

    for batch in batches:
        names = ("gid", "doc", "tkey", "pos", "times", "l", "bytes")
        for g, d, t, p, times, left, raw in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            if g != group:
                close()
                own, group = [], g
                if len(portion.symbols) > PORTION:
                    yield from flush()
                    portion = _Portion()
            own.append(((d, t, p, times), left, raw))
    close()
    yield from flush()


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, tkey, n_bytes, n_removed, n_spans, kept) per packed text and its intervals."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows: list[list] = [[], [], [], []]
        for k in range(batch.num_rows):
            text = unpack.decompress(batch.column(2)[k].as_buffer().to_pybytes())
            kept, removed, spans, end = [], 0, 0, 0
            gone = batch.column(3)[k].values
            pairs = [] if gone is None else sorted(zip(gone.field("start").to_pylist(), gone.field("stop").to_pylist(), strict=True))
            for a, b in pairs:
                if a > end or not spans:
                    kept.append(text[end:a])
                    spans += 1
                    removed += b - a
                    end = b
                elif b > end:
                    removed += b - end
                    end = b
            kept.append(text[end:])
            for column, v in zip(rows, (len(text), removed, spans, b"".join(kept)), strict=True):
                column.append(v)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in rows[:3]),
                                          pa.array(rows[3], pa.binary())], names=[*KEY, "n_bytes", "n_removed", "n_spans", "kept"])


def _halves(places: DataFrame) -> DataFrame:
    """Both halves of every place's range of offsets: places cut to the strings of their half, and grouped by the bytes
    that all these strings share.  Places without a string in a half leave it."""
    middle = ((F.col("lo") + F.col("hi")) / 2).cast("int")
    half = F.explode(F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi"))))
    both = places.where("hi - lo > 1").withColumn("half", half).withColumns({"lo": F.col("half.lo"), "hi": F.col("half.hi")}).drop("half")
    fits = both.where((F.col("l") >= F.col("lo")) & (F.col("r") >= SPAN + 1 - F.col("hi")))
    cut = fits.withColumns({"before": F.least("l", F.col("hi") - 1), "after": F.least("r", SPAN - F.col("lo"))})
    shared = F.expr(f"substring(bytes, l - lo + 1, {SPAN + 1} - (hi - lo))")
    return cut.select(F.xxhash64("gid", "lo", "hi", shared).alias("gid"), *KEY, "pos", "times", "lo", "hi", F.col("before").alias("l"),
                      F.col("after").alias("r"), F.expr("substring(bytes, l - before + 1, before + after)").alias("bytes"))


def _interval() -> list:
    return [*KEY, (F.col("pos") - F.col("l")).alias("start"), (F.col("pos") + F.col("r")).alias("stop")]


def _one_per_text(places: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(intervals of places whose bytes another place of the group has as a whole, one place per distinct bytes).

    Bytes are shuffled once, after equal ones are combined; places are matched with the counts without their bytes.
    """
    named = places.withColumn("h", F.sha2("bytes", 256))
    one = scratch.write(named.groupBy("gid", "h").agg(F.sum("times").alias("total"), F.min(F.struct(*KEY, "pos", "l", "r", "lo", "hi")).alias("one"),
                                                      F.first("bytes").alias("bytes")))
    again = one.where("total > 1").select("gid", "h")
    whole = named.drop("bytes").join(again, ["gid", "h"]).where(F.col("l") + F.col("r") >= SPAN).select(*_interval())
    return scratch.write(whole), one


def _wanted(places: DataFrame) -> DataFrame:
    """Places of groups with two or more, one of which at least is not known to repeat as a whole."""
    groups = places.groupBy("gid").agg(F.count("*").alias("n"), F.min("times").alias("least")).where("n > 1 and least = 1")
    return places.join(groups.select("gid", F.col("n").alias("group_size")), "gid")


def repeated_intervals(keyed: DataFrame) -> DataFrame:
    """(doc, tkey, start, stop): intervals of bytes that are repeated; they may overlap.  ``keyed``: doc, tkey, text.

    Every table between two steps is dropped when the next ones are written; only intervals stay."""
    scratch = Scratch(keyed.sparkSession)
    marks = scratch.write(keyed.mapInArrow(_anchor_rows, ANCHORS))
    shared = marks.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    places = scratch.write(marks.join(shared, "anchor"))
    scratch.drop(marks)
    # Equal surroundings: repeated as a whole; one place stands for all.
    totals = scratch.write(places.groupBy("anchor", "around").agg(F.count("*").alias("times"), F.min(F.struct(*KEY, "place")).alias("one")))
    again = totals.where("times > 1").select("anchor", "around")
    at = [F.expr(e).alias(name) for name, e in PLACE.items()]
    whole = places.join(again, ["anchor", "around"], "left_semi").select(*KEY, *at).where(F.col("l") + F.col("r") >= SPAN)
    found = [scratch.write(whole.select(*_interval()))]
    scratch.drop(places)
    mixed = (totals.groupBy("anchor").agg(F.count("*").alias("n"), F.min("times").alias("least")).where("n > 1 and least = 1")
             .select("anchor", F.col("n").alias("group_size")))
    asked = (totals.join(mixed, "anchor").select("anchor", "group_size", "times", "one.*").groupBy(*KEY)
             .agg(F.collect_list(F.struct("anchor", "group_size", "times", "place")).alias("asked")))
    texts = keyed.mapInArrow(_pack, "doc long, tkey long, packed binary").join(asked, KEY)
    cut = texts.select(*KEY, "packed", "asked").mapInArrow(
        _cut, "doc long, tkey long, anchor long, group_size long, times long, pos long, l int, r int, bytes binary")
    # A row repeated in full brings its places again; they repeat as a whole, so nothing is learnt about them below.
    group = scratch.write(cut.withColumnRenamed("anchor", "gid").withColumns({"lo": F.lit(0), "hi": F.lit(WINDOW)}))
    scratch.drop(totals)
    tasks = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        small = group.where(F.col("group_size") <= MOST)
        # A number of partitions, as sorting costs far more than its few bytes suggest.
        ordered = small.repartition(tasks, "gid").sortWithinPartitions("gid")
        found.append(scratch.write(ordered.select("gid", *KEY, "pos", "times", "l", "bytes").mapInArrow(_agreements, INTERVALS)))
        large = group.where((F.col("group_size") > MOST) & (F.col("hi") - F.col("lo") > 1)).drop("group_size")
        if large.isEmpty():
            break
        # One round per halving: all ranges of all large groups at a time.
        equal, one = _one_per_text(_halves(large), scratch)
        found.append(equal)
        rest = one.select("gid", "one.*", F.col("total").alias("times"), "bytes")
        last, group = group, scratch.write(_wanted(rest))
        scratch.drop(last, one)
    scratch.drop(group)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row of ``docs`` (doc_id, text); ``kept``: remaining bytes."""
    keyed = _keyed(docs)
    gone = repeated_intervals(keyed).groupBy(*KEY).agg(F.collect_set(F.struct("start", "stop")).alias("gone"))
    packed = keyed.mapInArrow(_pack, "doc long, tkey long, packed binary")
    out = packed.join(gone, KEY, "left").select(*KEY, "packed", "gone").mapInArrow(
        _united, "doc long, tkey long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")
