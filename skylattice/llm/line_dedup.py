"""Line deduplication by winnowing over line hashes.

The lines of a text that are not blank are hashed. A window is a shortest run of
consecutive lines with ``MIN_WORDS`` words or more, from each line forwards and
from each line backwards; its fingerprint is the least line hash in it. Any run
of that many words that occurs twice has the same windows, and so the same
fingerprints, in both places: fingerprints that occur at one place only are
dropped first. The windows around the others are joined by position: each is
matched with the first place (least doc_id, then line) where the same lines
stand. Matches at the same distance from the same source are extended both ways
into maximal runs, and every later occurrence is deleted. A line goes if and only
if it lies in a run of ``MIN_WORDS`` words or more that has occurred before.

Everything is DataFrame functions. A line that a third of all documents share is
one group of an aggregate, which is combined before the shuffle. The aggregates are
stored, so that the joins back to the places are ones whose skewed partitions Spark
splits. The texts are shuffled once, for the lines to delete.

A null or empty text has no lines and stays as it is. Blank lines stay. Rows
without a doc_id are neither sources nor changed. Rows that repeat a doc_id are
told apart by their texts; of fully equal rows none is later than the other, and
both keep their lines. Other columns are passed through, but for own ones with the
names of the two that are added, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylattice.llm.workspace import Workspace

MIN_WORDS = 50
ADDED = ("dedup_lines", "dedup_removed")
WORD = r"[^\x20\x09-\x0D]+"


def line_hashes(documents: DataFrame) -> DataFrame:
    """(doc_id, tag, kept): two hashes h, g and the number of words n of every line that is not blank."""
    lines = documents.where("doc_id is not null and text is not null").select(
        "doc_id", F.xxhash64("text").alias("tag"),
        F.transform(F.split("text", "\n"), lambda x: F.struct(
            F.xxhash64(x).alias("h"), F.xxhash64(F.lit("again"), x).alias("g"), F.regexp_count(x, F.lit(WORD)).alias("n"),
        )).alias("all"),
    )
    return lines.select("doc_id", "tag", F.filter("all", lambda x: x["n"] > 0).alias("kept"))


def windows(hashed: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, tag, first, last, key, again, mark) of every window of ``line_hashes``.

    Lines that are not blank count from 1. ``key`` and ``again`` hash the window's
    lines, ``mark`` is its fingerprint. ``hashed`` should be a stored table: an
    array worked out again inside a function over it would take the square of its length.
    """
    lines = hashed.select("doc_id", "tag", F.expr("kept.h").alias("h"), F.expr("kept.g").alias("g"), F.expr("kept.n").alias("n"))
    # A line has a word at least, so that no window is longer than `min_words` lines; most are far shorter.
    def reach(at: str, cut: str) -> str:
        def over(size: int) -> str:
            return (
                f"aggregate({cut.format(size=size)}, named_struct('sum', 0, 'len', 0), (s, x) -> "
                f"if(s.sum >= {min_words}, s, named_struct('sum', s.sum + x, 'len', s.len + 1)))"
            )

        few = over(min(6, min_words))
        return f"if(n[{at} - 1] >= {min_words}, named_struct('sum', n[{at} - 1], 'len', 1), if({few}.sum >= {min_words}, {few}, {over(min_words)}))"

    each = "transform(if(size(n) > 0, sequence(1, size(n)), array())"
    ahead = reach("p", "slice(n, p, {size})")
    back = reach("q", "reverse(slice(n, greatest(1, q - {size} + 1), least(q, {size})))")
    lines = lines.withColumn("forward", F.expr(f"{each}, p -> {ahead})")).withColumn("backward", F.expr(f"{each}, q -> {back})"))
    # A backward window that is also the forward one of its first line is left out.
    spans = F.expr(
        f"concat(filter(transform(forward, (s, i) -> if(s.sum >= {min_words}, named_struct('first', i + 1, 'last', i + s.len), null)), x -> x is not null), "
        f"filter(transform(backward, (s, i) -> if(s.sum - n[i] >= {min_words}, named_struct('first', i + 2 - s.len, 'last', i + 1), null)), x -> x is not null))"
    )
    found = lines.withColumn("spans", spans).select("doc_id", "tag", F.inline(F.expr(
        "transform(spans, s -> named_struct('first', s.first, 'last', s.last, "
        "'key', xxhash64(slice(h, s.first, s.last - s.first + 1)), 'again', xxhash64(slice(g, s.first, s.last - s.first + 1)), "
        "'mark', array_min(slice(h, s.first, s.last - s.first + 1))))"
    )))
    return found


def repeated_runs(documents: DataFrame, min_words: int = MIN_WORDS, work: Workspace | None = None) -> DataFrame:
    """(doc_id, tag, start, end, source, source_tag, source_start): maximal runs of lines that stand in an earlier place."""
    work = work or Workspace(documents.sparkSession)
    hashed = work.stage(line_hashes(documents))
    found = work.stage(windows(hashed, min_words))
    work.drop(hashed)
    place = F.struct("doc_id", "tag", "first")
    # A fingerprint at one place only, or of one window only, cannot be part of a repeated run.
    marks = work.stage(found.groupBy("mark").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo <> hi").select("mark"))
    open_ = found.join(marks, "mark", "left_semi")
    source = open_.groupBy("key", "again").agg(F.min(place).alias("source"), F.max(place).alias("hi")).where("source <> hi").drop("hi")
    source = work.stage(source)
    later = open_.join(source, ["key", "again"]).where(place != F.col("source"))
    later = later.select(
        "doc_id", "tag", "first", "last", F.col("source.doc_id").alias("source"), F.col("source.tag").alias("source_tag"),
        (F.col("source.first") - F.col("first")).alias("shift"),
    )
    by = ["doc_id", "tag", "source", "source_tag", "shift"]
    before = Window.partitionBy(*by).orderBy("first", "last")
    reach = F.max("last").over(before.rowsBetween(Window.unboundedPreceding, -1))
    later = later.withColumn("fresh", F.when(reach.isNull() | (F.col("first") > reach + 1), 1).otherwise(0))
    later = later.withColumn("run", F.sum("fresh").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    runs = later.groupBy(*by, "run").agg(F.min("first").alias("start"), F.max("last").alias("end"))
    return runs.select("doc_id", "tag", "start", "end", "source", "source_tag", (F.col("start") + F.col("shift")).alias("source_start"))


def remove_repeated_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``documents`` with the later occurrences of repeated runs deleted from ``text``.

    Added columns: dedup_lines, the lines that are not blank, and dedup_removed, how many went.
    """
    work = Workspace(documents.sparkSession)
    runs = repeated_runs(documents.select("doc_id", "text"), min_words, work)
    gone = runs.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("start", "end")).alias("runs"))
    gone = work.stage(gone.select(
        F.col("doc_id").alias("gone_id"), F.col("tag").alias("gone_tag"),
        F.expr("array_distinct(flatten(transform(runs, r -> sequence(r.start, r.end))))").alias("dedup__gone"),
    ))
    # What is gone grows with the documents, so it is never broadcast: the plan is the same at every size.
    same = (F.col("doc_id") == F.col("gone_id")) & (F.xxhash64("text") == F.col("gone_tag"))
    own = [c for c in documents.columns if c != "text" and c not in ADDED]
    rows = documents.select(F.struct(*own).alias("row"), "doc_id", "text").join(gone.hint("merge"), same, "left")
    rows = rows.withColumn("dedup__all", F.split("text", "\n")).withColumn("dedup__solid", F.expr(
        f"filter(sequence(0, size(dedup__all) - 1), i -> regexp_like(dedup__all[i], r'{WORD}'))"
    ))
    left = (
        "array_join(transform(array_except(sequence(0, size(dedup__all) - 1), "
        "transform(dedup__gone, x -> dedup__solid[x - 1])), i -> dedup__all[i]), '\n')"
    )
    clean = F.expr(f"if(dedup__gone is null, text, {left})")
    return rows.select(
        *(clean.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in documents.columns if c not in ADDED),
        F.expr("if(text is null, 0, size(dedup__solid))").cast("long").alias("dedup_lines"),
        F.expr("if(dedup__gone is null, 0, size(dedup__gone))").cast("long").alias("dedup_removed"),
    )


def plain_sql(min_words: int = MIN_WORDS) -> str:
    """The same in SQL for DuckDB: every run of lines with enough words, compared as text with all earlier ones."""
    word = WORD.replace("\\", "\\")
    return f"""
    with raw as (select doc_id, text, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) i from documents where text is not null),
    counted as (select *, len(regexp_extract_all(line, '{word}')) n from raw),
    solid as (select *, row_number() over (partition by doc_id order by i) p, sum(n) over (partition by doc_id order by i) c from counted where n > 0),
    runs as (select a.doc_id, a.p first, b.p last, a.c - a.n + {min_words} goal, b.c - {min_words} floor_, a.c ac, a.n an, b.c bc, b.n bn
        from solid a join solid b on a.doc_id = b.doc_id and b.p between a.p and a.p + {min_words} and b.c >= a.c - a.n + {min_words}),
    least_ as (select doc_id, first, last from runs where bc - bn < goal or ac > floor_),
    keyed as (select l.doc_id, l.first, l.last, string_agg(s.line, chr(10) order by s.p) k
        from least_ l join solid s on s.doc_id = l.doc_id and s.p between l.first and l.last group by all),
    later as (select doc_id, first, last from (select *, row_number() over (partition by k order by doc_id, first) r from keyed) where r > 1),
    gone as (select distinct s.doc_id, s.i from later l join solid s on s.doc_id = l.doc_id and s.p between l.first and l.last),
    counts as (select c.doc_id, sum((n > 0)::int)::bigint dedup_lines, count(g.i)::bigint dedup_removed,
            string_agg(line, chr(10) order by c.i) filter (where g.i is null) left_
        from counted c left join gone g on g.doc_id = c.doc_id and g.i = c.i group by c.doc_id)
    select d.doc_id, case when d.text is not null then coalesce(left_, '') end text,
        coalesce(dedup_lines, 0) dedup_lines, coalesce(dedup_removed, 0) dedup_removed
    from documents d left join counts using (doc_id)"""
