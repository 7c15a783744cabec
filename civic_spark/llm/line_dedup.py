r"""Line dedup with DataFrame functions only: a suffix array over line-id sequences by distributed prefix doubling, two
or four doublings a round.

A document is its sequence of non-blank lines (separated by ``\n``).  A run of ``min_lines`` lines or more, or a single
line of ``min_chars`` characters or more, that also stands earlier is a later copy; its lines are deleted.  Earlier
means a smaller (doc_id, text hash, line number).  Runs are judged on the input; blank lines stay.

1. A line's id is a 128-bit hash.  Lines that occur once end every run, so only repeated ones go on (a count per line,
   combined before the shuffle).  A suffix reaches from its line to the end of its run of repeated lines; its rank is
   the number of suffixes that sort before it, by one line at first.
2. Doubling: a suffix of a shared rank is listed with the ranks of the suffixes ``width``, twice ``width`` and so on
   lines ahead (an ended one sorts first), read from its document in line order, and running sums over the
   range-partitioned lists rank them within their old rank.  Every exchange costs the driver a thread, a plan and its
   figures, however few the rows, so a round does two doublings, and four once fewer suffixes are left.  A suffix whose
   rank is its own, or which has ended, is in its final place and moves no more.  Doubling stops when no shared suffix
   goes on: the ranks are then the suffix array; suffixes that still share a rank are equal to their ends.
3. Common prefixes: ranks count suffixes, so the next entry of the array has the rank ``rank + n``.  The length that
   two neighbours share is found by descending through the levels of the doubling, from the widest: equal ranks at a
   level add its width, as often as one round went on.  Entries that are equal to their ends share all their lines.
4. Intervals: neighbours that share ``min_lines`` lines or more are in one interval, numbered by a running count of the
   cuts.  All but the interval's earliest suffix are later copies; what they cover, united per document, are the maximal
   repeated runs (``repeated_runs`` lists them).

No group meets in one task: counts are combined before their shuffle, ranks come from ranges, and a join by a name that
more than one in ``HEAVY`` suffixes carry deals its rows over ``SHARES`` copies of that name.  At most ``HEAVY`` names
can be so frequent, which bounds the broadcast list of them.

Defined results: a null text has no lines and stays null; documents with the same id and different texts are apart;
rows repeated in full are one document for the search, and each loses the same lines; null ids sort first; very long
texts are read whole, a document's own numbers of deleted lines being the only list that is formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civic_spark.llm.shared import Scratch, global_rank, global_sums, written

MIN_LINES, MIN_CHARS = 2, 200
KEY = ["doc", "tkey"]
PLACE = [*KEY, "seq"]
#: Stands for a null id.
NO_ID = -(1 << 63)
#: A name of more than one in HEAVY rows is dealt over SHARES copies.
HEAVY, SHARES = 1024, 64
#: The first round, of all repeated lines, ranks by FIRST_STEP lines; later ones by STEP times those of the round before.
FIRST_STEP, STEP = 4, 16


def _keyed(docs: DataFrame) -> list[Column]:
    return [F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(docs["text"].cast("string")).alias("tkey")]


def line_sequences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, tkey, seq, line_no, a, b, long): the non-blank lines of all texts, numbered from 0."""
    lines = F.split(docs["text"].cast("string"), "\n", -1)
    numbered = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("line_no"), x.alias("line"))),
                        lambda s: F.trim(s["line"], F.lit(" \t\r\x0b\x0c")) != "")
    rows = docs.where(docs["text"].isNotNull()).select(*_keyed(docs), F.posexplode(numbered).alias("seq", "at"))
    line = F.col("at.line")
    return rows.select(*KEY, "seq", F.col("at.line_no").alias("line_no"), F.xxhash64(line).alias("a"),
                       F.xxhash64(F.lit(1), line).alias("b"), (F.length(line) >= min_chars).alias("long"))


def _joined(rows: DataFrame, names: DataFrame, by: list[str], total: int, size: str = "n") -> DataFrame:
    """Inner join of ``rows`` with ``names`` (one row per ``by``, with how many rows carry it), frequent names dealt.

    ``total`` is at least the sum of the sizes, so fewer than ``HEAVY`` names are frequent and their list is broadcast.
    """
    frequent = F.col(size) * HEAVY > total
    heavy = names.where(frequent).select(*by, F.lit(True).alias("__heavy"))
    share = F.pmod(F.xxhash64(*rows.columns), F.lit(SHARES)).cast("int")
    dealt = (rows.join(F.broadcast(heavy), by, "left")
             .withColumn("__share", F.when(F.col("__heavy"), share).otherwise(0)).drop("__heavy"))
    shares = F.when(frequent, F.sequence(F.lit(0), F.lit(SHARES - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(names.withColumn("__share", F.explode(shares)), [*by, "__share"]).drop("__share")


def _suffixes(lines: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """(doc, tkey, seq, line_no, long, rest, rank, n) of every repeated line, and how many there are.

    ``rest`` counts the lines up to the end of its run of repeated lines, ``rank`` is by the line alone and ``n`` its
    frequency.
    """
    counts = scratch.write(lines.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    # A row repeated in full brings the same places again; lines that only such rows repeat are not shared.
    own = scratch.write(_joined(lines, counts, ["a", "b"], total).drop("n").dropDuplicates(PLACE))
    shared = own.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
    names = scratch.write(global_rank(shared, ["a", "b"], weight=F.col("n"), store=scratch.write))
    ranked = _joined(own, names, ["a", "b"], total).drop("a", "b")
    run = F.col("seq") - F.row_number().over(Window.partitionBy(*KEY).orderBy("seq"))
    rest = F.max("seq").over(Window.partitionBy(*KEY, "__run")) - F.col("seq") + 1
    return scratch.write(ranked.withColumn("__run", run).withColumn("rest", rest).drop("__run")), total


def _array(first: DataFrame, total: int, scratch: Scratch) -> tuple[DataFrame, list[tuple[int, int, DataFrame]]]:
    """The suffix array (doc, tkey, seq, rest, rank, n) and its levels (width, step, places that share ``width`` lines).

    The next level is ``step`` times as wide; ``ahead1``, ``ahead2`` and so on are the ranks that many widths on, -1 behind
    the end.  The last level's places end with its width.
    """
    cols = [*PLACE, "rest", "rank", "n"]
    # Of the suffixes that are live at this width, "before" sort before the rank.
    start = first.select(*cols, F.col("rank").alias("before"))
    width, known, moved, levels = 1, start.withColumn("width", F.lit(1)), [], []
    shared = (F.col("n") > 1) & (F.col("rest") >= F.col("width"))
    while not known.where(shared & (F.col("width") == width) & (F.col("rest") > width)).isEmpty():
        step = FIRST_STEP if width == 1 else STEP
        lines = Window.partitionBy(*KEY).orderBy("seq")
        on = {f"ahead{k}": F.when(F.col("rest") > k * width, F.first("rank").over(lines.rangeBetween(k * width, k * width))).otherwise(-1)
              for k in range(1, step)}
        level = scratch.write(known.withColumns(on).where(shared & (F.col("width") == width)).select(*PLACE, "rest", "rank", "before", *on))
        levels.append((width, step, level))
        width *= step
        kept = len(scratch.held)
        groups = level.groupBy("rank", "before", *on).agg(F.count("*").alias("n"), F.min("rest").alias("rest"))
        live = F.when((F.col("n") > 1) & (F.col("rest") >= width), F.col("n")).otherwise(0)
        upto = global_sums(groups, ["rank", *on], {"upto": F.col("n"), "live": live}, scratch.write)
        names = scratch.write(upto.select("rank", *on, "n", (F.col("rank") + F.col("upto") - F.col("before")).alias("new"), "live"))
        moved.append(scratch.write(_joined(level.drop("before"), names, ["rank", *on], total).drop("rank", *on)
                                   .withColumnsRenamed({"new": "rank", "live": "before"}).withColumn("width", F.lit(width))
                                   .select(*cols, "before", "width")))
        scratch.drop(*[t for t, _ in scratch.held[kept:-1]])
        known = scratch.together(moved).where(~shared | (F.col("width") == width))
    return known.select(*cols), [*levels, (width, 2, known.where(shared & (F.col("width") == width)))]


def _common(groups: DataFrame, levels: list[tuple[int, int, DataFrame]], min_lines: int, scratch: Scratch) -> DataFrame:
    """(rank, lcp): the lines that an entry of the array shares with the next one, where these are ``min_lines`` or more."""
    end = lambda name: [F.col(f"first.{c}").alias(f"{name}_{c}") for c in PLACE]
    able = groups.where(F.col("rest") >= min_lines)
    after = able.select(F.col("rank").alias("next"), *end("q"))
    pairs = able.select("rank", (F.col("rank") + F.col("n")).alias("next"), *end("p")).join(after, "next").drop("next")

    def matched(rows: DataFrame, width: int, step: int, level: DataFrame) -> DataFrame:
        """Adds ``same``: how many times ``width`` lines both go on alike from ``lcp``, below ``step``."""
        ranks = ["rank", *[f"ahead{k}" for k in range(1, step - 1)]]
        for side in "pq":
            at = level.select(*[F.col(c).alias(f"{side}_{c}") for c in KEY], F.col("seq").alias(f"{side}_at"),
                              F.struct("rest", *ranks).alias(f"{side}_on"))
            rows = (rows.withColumn(f"{side}_at", F.col(f"{side}_seq") + F.col("lcp"))
                    .join(at, [*[f"{side}_{c}" for c in KEY], f"{side}_at"], "left").drop(f"{side}_at"))
        same = F.lit(step - 1)
        for k in reversed(range(step - 1)):  # suffixes that end within the width may share a rank, but no width of lines
            alike = (F.col(f"p_on.{ranks[k]}") == F.col(f"q_on.{ranks[k]}")) & (F.col("p_on.rest") >= (k + 1) * width)
            same = F.when(alike, same).otherwise(k)
        return rows.withColumn("same", same).drop("p_on", "q_on")

    # Most neighbours part early: those that differ within the widest level up to min_lines leave first.
    width, step, screen = max((x for x in levels if x[0] <= min_lines), key=lambda x: x[0])
    pairs = scratch.write(matched(pairs.withColumn("lcp", F.lit(0)), width, step, screen)
                          .where(F.col("same") >= min(step - 1, min_lines // width)).drop("same"))
    for k, (width, step, level) in enumerate(reversed(levels)):
        if k and k % 4 == 0:
            pairs = scratch.write(pairs)
        pairs = matched(pairs, width, step, level).withColumn("lcp", F.col("lcp") + F.col("same") * width).drop("same")
    return scratch.write(pairs.where(F.col("lcp") >= min_lines).select("rank", "lcp"))


def _later(first: DataFrame, total: int, min_lines: int, scratch: Scratch) -> DataFrame:
    """(doc, tkey, seq, head, copies): suffixes of an interval but its earliest, ``head``; ``copies`` counts them all."""
    places, levels = _array(first, total, scratch)
    groups = scratch.write(places.groupBy("rank").agg(F.min(F.struct(*PLACE)).alias("first"), F.count("*").alias("n"), F.max("rest").alias("rest")))
    common = _common(groups, levels, min_lines, scratch)
    cut = F.when(F.col("lcp").isNull(), 1).otherwise(0)
    entries = scratch.write(global_rank(groups.join(common, "rank", "left"), ["rank"], weight=cut, rank="interval", store=scratch.write)
                            .where(F.col("rest") >= min_lines))
    heads = (entries.groupBy("interval").agg(F.min("first").alias("head"), F.sum("n").alias("copies"), F.count("*").alias("entries"))
             .where("copies > 1"))
    named = scratch.write(_joined(entries.select("rank", "n", "interval"), scratch.write(heads), ["interval"], total, "entries")
                          .select("rank", "n", "head", "copies"))
    return _joined(places.select(*PLACE, "rank"), named, ["rank"], total).where(F.struct(*PLACE) != F.col("head")).select(*PLACE, "head", "copies")


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """(doc, tkey, seq, n_lines, first_doc, first_tkey, first_seq, copies): the maximal runs that are later copies.

    Places that follow each other and all start a later copy form a run; it is ``min_lines - 1`` lines longer than they
    are.  ``first_...`` is the earliest place of the run's first ``min_lines`` lines and ``copies`` how often these occur.
    ``seq`` numbers the non-blank lines of a document.
    """
    scratch = Scratch(docs.sparkSession)
    first, total = _suffixes(line_sequences(docs), scratch)
    later = scratch.write(_later(first, total, min_lines, scratch))
    run = F.col("seq") - F.row_number().over(Window.partitionBy(*KEY).orderBy("seq"))
    start = F.min(F.struct("seq", "head", "copies"))
    return (later.withColumn("__run", run).groupBy(*KEY, "__run").agg(start.alias("s"), F.count("*").alias("n"))
            .select(*KEY, F.col("s.seq").alias("seq"), (F.col("n") + min_lines - 1).alias("n_lines"),
                    *[F.col(f"s.head.{c}").alias(f"first_{c}") for c in PLACE], F.col("s.copies").alias("copies")))


def deleted_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS, scratch: Scratch | None = None) -> DataFrame:
    """(doc, tkey, line_no) of every line that belongs to a later copy."""
    scratch = scratch or Scratch(docs.sparkSession)
    first, total = _suffixes(line_sequences(docs, min_chars), scratch)
    long = first.where("long").select(*PLACE, "rank")
    heads = scratch.write(long.groupBy("rank").agg(F.min(F.struct(*PLACE)).alias("head"), F.count("*").alias("n")).where("n > 1"))
    single = _joined(long, heads, ["rank"], total).where(F.struct(*PLACE) != F.col("head")).select(*PLACE)
    window = F.explode(F.sequence(F.col("seq"), F.col("seq") + (min_lines - 1))).alias("seq")
    windows = _later(first, total, min_lines, scratch).select(*KEY, window)
    return single.union(windows).distinct().join(first.select(*PLACE, "line_no"), PLACE).select(*KEY, "line_no")


def _kept_runs(lines: Column, gone: Column) -> Column:
    """Array of (from, size) of the lines kept, given the sorted numbers of the deleted ones."""
    starts = F.concat(F.array(F.lit(0)), F.transform(gone, lambda x: x + 1))
    ends = F.concat(gone, F.array(F.size(lines)))
    return F.filter(F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("at"), (e - s).alias("n"))), lambda r: r["n"] > 0)


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """All columns of ``docs`` plus ``__text``, ``__n_lines``, ``__n_removed``: the text without its later copies.

    Documents are joined with the numbers of their deleted lines; a text is rebuilt from slices of its lines, in time
    linear in its length.
    """
    scratch = Scratch(docs.sparkSession)
    gone = deleted_lines(docs, min_lines, min_chars, scratch)
    # The lists grow with the documents: a checkpoint has no file size by which a small one would be broadcast.
    per_doc = written(gone.groupBy(*KEY).agg(F.sort_array(F.collect_list("line_no")).alias("__gone"))
                      .withColumnsRenamed({k: f"__{k}" for k in KEY}))
    scratch.drop(*[t for t, _ in scratch.held])
    doc, tkey = _keyed(docs)
    text, missed = docs["text"].cast("string"), F.col("__gone").isNull()
    lines = F.split(text, "\n", -1)
    slices = F.flatten(F.transform(_kept_runs(lines, F.col("__gone")), lambda r: F.slice(lines, r["at"] + 1, r["n"])))
    return (docs.select("*", doc.alias("__k0"), tkey.alias("__k1"))
            .join(per_doc, (F.col("__k0") == F.col("__doc")) & (F.col("__k1") == F.col("__tkey")), "left")
            .select(*[docs[c] for c in docs.columns],
                    F.when(missed, text).otherwise(F.array_join(slices, "\n")).alias("__text"),
                    F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long").alias("__n_lines"),
                    F.when(missed, 0).otherwise(F.size("__gone")).cast("long").alias("__n_removed")))


#: DuckDB: the same windows by plain grouping of lines and of neighbouring pairs (min_lines 2, min_chars 200).
ORACLE_SQL = r"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
rows AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS line_no FROM docs),
own AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS seq FROM rows
        WHERE trim(line, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) <> ''),
pairs AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY seq) AS next_line,
                 lead(line_no) OVER (PARTITION BY doc_id ORDER BY seq) AS next_no FROM own),
singles AS (SELECT doc_id, line_no, row_number() OVER (PARTITION BY line ORDER BY doc_id, line_no) AS k
            FROM own WHERE length(line) >= 200),
doubles AS (SELECT doc_id, line_no, next_no, row_number() OVER (PARTITION BY line, next_line ORDER BY doc_id, line_no) AS k
            FROM pairs WHERE next_line IS NOT NULL),
gone AS (SELECT doc_id, line_no FROM singles WHERE k > 1
         UNION SELECT doc_id, line_no FROM doubles WHERE k > 1
         UNION SELECT doc_id, next_no FROM doubles WHERE k > 1),
kept AS (SELECT r.doc_id, string_agg(r.line, chr(10) ORDER BY r.line_no) AS text, count(*) AS n
         FROM rows r ANTI JOIN gone g ON r.doc_id = g.doc_id AND r.line_no = g.line_no GROUP BY r.doc_id)
SELECT d.doc_id, coalesce(len(d.ls), 0)::BIGINT AS n_lines,
       (coalesce(len(d.ls), 0) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
