"""Line deduplication by a suffix array over line-ID sequences (DataFrame operators only).

Lines are named by ID; IDs that occur once cannot belong to a repeat and leave at once. Prefix doubling then
ranks the windows of 2, 4, 8 ... lines, until no window repeats: the rank of 2h lines comes from the pair of ranks of h lines at i and
i + h, named in sorted order, so ranks are those of a suffix array cut at that depth. Windows that occur once leave
after each round, so a round has as many rows as there are lines in repeats of its depth. Windows of equal rank at depth h are the intervals of the suffix array
whose longest common prefix is h lines or more. All but the first place of an interval, by (doc_id, line number),
are later copies; in a document they overlap or touch up to its maximal repeated runs, whose lines are deleted.
Repeats of a depth between two rounds are covered by windows of the lesser one. A single line of long_words words or more is a passage of its own and is deleted, too, where it comes later.

Cases: lines are split at \\n; a null or empty text has one empty line; very long texts are read whole, a row a line. Ties of doc_id are ordered by the text's
digest; of rows equal in id and text one is the first, and the others lose all that has min_lines lines or long_words words. A run that overlaps itself (A A A) keeps what precedes its second
start. Null ids sort first. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import load, materialise, row_key, text_or_empty

#: Runs of fewer lines stay, as one line alone is often a heading or a date; unless it has LONG_WORDS words.
MIN_LINES, LONG_WORDS = 2, 51
WORD = r"[^\x20\x09-\x0D]+"


def _ranked(windows: DataFrame, names: list[str], label: str) -> DataFrame:
    """names, deep (the rank), first (doc, key, i): one row for each name that occurs twice or more, ranked in the order of names.

    Partial aggregation precedes the shuffle, so that a hot line is one row a task. The rank is the row's place after a
    range sort, fixed by writing it.
    """
    place = F.struct("doc", "key", "i")
    repeated = windows.groupBy(*names).agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    return materialise(repeated.repartitionByRange(*names).sortWithinPartitions(*names).withColumn("deep", F.monotonically_increasing_id()), label)


def repeated_windows(docs: DataFrame, *, min_lines: int = MIN_LINES, long_words: int | None = LONG_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, key, i, span, first: every place where span lines start that also start elsewhere, with the first such place.

    span is min_lines, its doubles as far as anything repeats, and 1 for lines of long_words words or more. Rows of documents equal in id and text
    share doc and key; their places come once for each of them.
    """
    if min_lines < 1:
        raise ValueError("min_lines must be at least 1")
    t = text_or_empty(text_col)
    lines = docs.select(F.col(id_col).alias("doc"), row_key(F.col(id_col), t).alias("key"), F.posexplode(F.split(t, "\n", -1)).alias("i", "line"))
    alone = F.regexp_count("line", F.lit(WORD)) >= long_words if long_words is not None and min_lines > 1 else F.lit(False)
    lines = materialise(lines.select("doc", "key", "i", F.unhex(F.md5(F.col("line").cast("binary"))).alias("line"), alone.alias("alone")), "lines")
    at = lines.join(_ranked(lines, ["line"], "line-ids"), "line").select("doc", "key", "i", F.col("deep").alias("rank"), "first", "alone")
    passages = at.where("alone").select("doc", "key", "i", F.lit(1).alias("span"), "first")
    found = [passages] if long_words is not None and min_lines > 1 else []
    depth = 1
    while True:
        if depth >= min_lines:
            found.append(at.select("doc", "key", "i", F.lit(depth).alias("span"), "first"))
        step = depth if depth >= min_lines else min(depth, min_lines - depth)  # up to min_lines two windows may overlap: together they have depth + step lines
        ahead = Window.partitionBy("key").orderBy("i").rangeBetween(step, step)
        pairs = at.withColumn("then", F.first("rank").over(ahead)).where(F.col("then").isNotNull()).select("doc", "key", "i", "rank", "then")
        pairs = materialise(pairs, f"pairs-{depth + step}")
        deeper = _ranked(pairs, ["rank", "then"], f"ranks-{depth + step}")
        at = pairs.join(deeper, ["rank", "then"]).select("doc", "key", "i", F.col("deep").alias("rank"), "first")
        depth += step
        if depth >= min_lines and deeper.isEmpty():
            break
        if depth > min_lines:
            at = materialise(at, f"windows-{depth}")
    if not found:  # nothing has min_lines lines and repeats
        found.append(at.select("doc", "key", "i", F.lit(min_lines).alias("span"), "first"))
    return reduce(DataFrame.unionByName, found)


def later_runs(at: DataFrame) -> DataFrame:
    """repeated_windows() -> key, own: the maximal runs (start, stop) of lines that later copies cover, in order."""
    is_first = F.col("first.doc").eqNullSafe(F.col("doc")) & (F.col("first.key") == F.col("key")) & (F.col("first.i") == F.col("i"))
    order = Window.partitionBy("key").orderBy("i", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    later = at.where(~is_first).select("key", "i", (F.col("i") + F.col("span")).alias("stop"))
    # a run starts where no window before reaches
    begun = later.withColumn("head", (reach.isNull() | (F.col("i") > reach)).cast("int"))
    told = begun.withColumn("run", F.sum("head").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    runs = told.groupBy("key", "run").agg(F.min("i").alias("start"), F.max("stop").alias("stop"))
    return runs.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("own"))


def line_dedup(docs: DataFrame, *, min_lines: int = MIN_LINES, long_words: int | None = LONG_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, text without the later copies, n_lines, removed (line numbers from 0, sorted), runs (start, stop)."""
    own = later_runs(repeated_windows(docs, min_lines=min_lines, long_words=long_words, id_col=id_col, text_col=text_col))
    rows = docs.select(F.col(id_col).alias("doc"), row_key(F.col(id_col), text_or_empty(text_col)).alias("key"), text_or_empty(text_col).alias("t"))
    # of rows equal in id and text, all but one are later copies throughout
    copy = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    cut = rows.join(own, "key", "left").select("doc", F.split("t", "\n", -1).alias("lines"), "own", (copy > 1).alias("again"))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    passages = F.filter(every, lambda i: F.regexp_count(F.get("lines", i), F.lit(WORD)) >= long_words) if long_words is not None else F.array().cast("array<int>")
    later = F.flatten(F.transform(F.coalesce("own", F.array().cast("array<struct<start:int,stop:int>>")), lambda x: F.sequence(x.start, x.stop - 1)))
    cut = cut.withColumn("removed", F.when(~F.col("again"), later).when(F.size("lines") >= min_lines, every).otherwise(passages))
    # a run starts at a removed line whose predecessor stays, and stops likewise
    after = F.transform("removed", lambda i: i + 1)
    runs = F.arrays_zip(F.array_except("removed", after).alias("start"), F.array_except(after, "removed").alias("stop"))
    kept = F.transform(F.array_except(every, "removed"), lambda i: F.get("lines", i))
    return cut.select(F.col("doc").alias(id_col), F.array_join(kept, "\n").alias(text_col), F.size("lines").cast("long").alias("n_lines"), "removed", runs.alias("runs"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents without the later copies of runs of MIN_LINES lines or more, and of lines of LONG_WORDS words or more."""
    out = line_dedup(load(spark, sf_dir, "documents"))
    said = F.array_join(F.transform("runs", lambda r: F.concat_ws(":", r.start, r.stop)), ",")
    return out.select(
        "doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.size("runs").cast("long").alias("n_runs"), said.alias("runs"), F.sha2("text", 256).alias("kept_sha256")
    )


SQL = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS i
    FROM documents),
win AS (
    SELECT doc_id, i, line,
           lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS then_line
    FROM lines),
firsts AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY line, then_line ORDER BY doc_id, i) AS nth
    FROM win WHERE then_line IS NOT NULL),
passages AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) AS nth
    FROM lines WHERE len(regexp_extract_all(line, '{WORD}')) >= {LONG_WORDS}),
gone AS (
    SELECT doc_id, i + k AS i FROM firsts, (VALUES (0), (1)) AS s(k) WHERE nth > 1
    UNION SELECT doc_id, i FROM passages WHERE nth > 1),
marked AS (
    SELECT l.doc_id, l.i, l.line, g.i IS NOT NULL AS cut
    FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i),
edges AS (
    SELECT *, cut AND NOT coalesce(lag(cut) OVER (PARTITION BY doc_id ORDER BY i), false) AS head FROM marked),
runs AS (
    SELECT doc_id, run, min(i) AS a, max(i) + 1 AS b
    FROM (SELECT *, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM edges)
    WHERE cut GROUP BY doc_id, run),
said AS (
    SELECT doc_id, count(*) AS n, string_agg(a || ':' || b, ',' ORDER BY a) AS runs FROM runs GROUP BY doc_id)
SELECT m.doc_id,
       CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE cut) AS BIGINT) AS n_removed,
       CAST(coalesce(max(s.n), 0) AS BIGINT) AS n_runs,
       coalesce(max(s.runs), '') AS runs,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT cut), '')) AS kept_sha256
FROM marked m LEFT JOIN said s ON s.doc_id = m.doc_id
GROUP BY m.doc_id
"""
