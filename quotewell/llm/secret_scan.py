"""Secret scans with an incremental blob ledger (DataFrame operators only).

Every version of every file is addressed by the SHA-256 of its content. The ledger holds, for each blob, the
rule versions that have scanned it and what they found. A run scans only pairs of blob and rule version that
the ledger lacks, appends them to it, and joins the findings back to all paths that have that content.

Spans are code-point offsets, end exclusive. Spark has no match positions, so a text is split at its matches, and the
lengths of the pieces and of the matches, summed in order, give them.

Cases: a null text counts as empty and has no findings. Equal texts share one scan; every path gets the findings, and so
does a path that comes twice. Ties (several kinds at one start) are listed in the order of RULES. Very long texts are read whole. Two runs that scan
the same pairs at once both append them; a finding still counts once. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_path, load, text_or_empty

SPANS = "array<struct<start:int,ord:int,end:int,kind:string>>"
LEDGER_SCHEMA = f"blob binary, rules array<string>, findings {SPANS}"


@dataclass(frozen=True)
class Rule:
    """A pattern of java.util.regex. measured: the group whose length must be at least least, or the match is dropped."""

    kind: str
    pattern: str
    version: int = 1
    measured: int = 0
    least: int = 1
    needs: str = ""  # a literal without which the pattern can't match

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


def _either(word: str) -> str:
    """A word in either case of A to Z only: with (?i), RE2 would also take U+017F for s and U+212A for k."""
    return "".join(f"[{x}{x.upper()}]" for x in word)


#: In the order in which kinds are listed. For access and hex the least length stands in the pattern: matches are whole runs.
RULES = (
    Rule("assign", f"({'|'.join(map(_either, ('password', 'passwd', 'secret', 'token')))}|{_either('api')}_?{_either('key')})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", measured=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", needs="AKIA"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]{1,16} ){0,4}PRIVATE KEY-----", needs="PRIVATE KEY"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", needs="eyJ"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", needs="gh"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,16}://[^\x00-\x20/:@]{1,128}:[^\x00-\x20/:@]{1,128}@", needs="://"),
)
BASE = ("assign", "access", "hex")


def _hits(rule: Rule, unseen: Column) -> Column:
    """array<struct<gap, len, ok>>, a row a match: code points since the match before it, its own, and whether it counts."""
    q = rule.pattern
    hits = F.regexp_extract_all("text", F.lit(q), F.lit(0))
    inner = F.regexp_extract_all("text", F.lit(q), F.lit(rule.measured)) if rule.measured else hits
    gaps = F.split("text", q, -1)
    # split() leaves one piece more than there are matches
    zipped = F.transform(F.arrays_zip(gaps.alias("g"), hits.alias("m"), inner.alias("i")), lambda x: F.struct(F.length(x.g).alias("gap"), F.length(x.m).alias("len"), (F.length(x.i) >= rule.least).alias("ok")))
    where = unseen & (F.contains(F.col("text"), F.lit(rule.needs)) if rule.needs else F.lit(True)) & F.col("text").rlike(q)
    return F.when(where, F.filter(zipped, lambda x: x.len.isNotNull()))


def _scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """blob, rules (the keys scanned now: those that `seen` lacks), findings. No shuffle beyond that of the blobs."""
    seen = F.coalesce("seen", F.array().cast("array<string>"))
    todo = F.array_except(F.array(*(F.lit(r.key) for r in rules)), seen)
    scans = F.array(*(F.struct(F.lit(k).alias("ord"), F.lit(r.kind).alias("kind"), _hits(r, ~F.array_contains(seen, r.key)).alias("hits")) for k, r in enumerate(rules)))
    raw = blobs.select("blob", todo.alias("rules"), F.filter(scans, lambda x: x.hits.isNotNull()).alias("scans"))
    each = raw.select("blob", "rules", F.explode_outer("scans").alias("s")).select("blob", "rules", "s.ord", "s.kind", F.posexplode_outer("s.hits").alias("at", "h"))
    run = Window.partitionBy("blob", "ord").orderBy("at")
    placed = each.withColumn("stop", F.sum(F.col("h.gap") + F.col("h.len")).over(run))
    span = F.struct((F.col("stop") - F.col("h.len")).cast("int").alias("start"), "ord", F.col("stop").cast("int").alias("end"), "kind")
    return placed.groupBy("blob").agg(F.first("rules").alias("rules"), F.collect_list(F.when(F.col("h.ok"), span)).alias("findings"))


def scan_versions(spark: SparkSession, versions: DataFrame, ledger: str, *, path_col: str = "path", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger (a Parquet folder that this call appends to) lacks; return path_col, blob, findings for every version.

    Findings are sorted by start, then by the order of rules. Only rules given here count; findings of older rule versions are
    superseded: the ledger's entries of a kind are read for the pairs scanned under the current versions.
    """
    keys = [r.key for r in rules]
    paths = versions.select(F.col(path_col).alias("path"), F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("blob"))
    texts = versions.select(F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("blob"), text_or_empty(text_col).alias("text"))
    blobs = texts.groupBy("blob").agg(F.first("text").alias("text"))  # combined before the shuffle: a hot blob is one row a task
    known = _read(spark, ledger)
    if known is None:
        fresh = blobs.withColumn("seen", F.lit(None).cast("array<string>"))
    else:
        seen = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        fresh = blobs.join(seen, "blob", "left").where(F.col("seen").isNull() | (F.size(F.array_except(F.array(*map(F.lit, keys)), "seen")) > 0))
    _scan(fresh, rules).write.mode("append").parquet(ledger)
    entries = _read(spark, ledger)
    valid = F.filter("findings", lambda f: F.exists("rules", lambda k: (F.substring_index(k, "@", 1) == f.kind) & F.array_contains(F.array(*map(F.lit, keys)), k)))
    order = F.create_map(*(x for k, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(k))))
    by_blob = entries.withColumn("findings", valid).where(F.size("findings") > 0).groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("findings"))
    ordered = F.array_sort(F.transform("findings", lambda f: F.struct(f.start.alias("start"), order[f.kind].alias("ord"), f.end.alias("end"), f.kind.alias("kind"))))
    once = F.filter("findings", lambda f, i: (i == 0) | (f != F.get("findings", i - 1)))
    by_blob = by_blob.withColumn("findings", ordered).withColumn("findings", once)
    return paths.join(by_blob, "blob", "left").select(F.col("path").alias(path_col), "blob", F.coalesce("findings", F.array().cast(SPANS)).alias("findings"))


def _read(spark: SparkSession, ledger: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents under RULES, through a new ledger in the shared folder."""
    docs = load(spark, sf_dir, "documents")
    found = scan_versions(spark, docs, fresh_path(spark, "ledger"), path_col="doc_id")
    return digest(found)


def digest(found: DataFrame) -> DataFrame:
    said = lambda spans: F.array_join(F.transform(spans, lambda f: F.concat_ws(":", f.kind, f.start, f.end)), ",")
    base = F.filter("findings", lambda f: f.kind.isin(*BASE))
    count = lambda kind: F.size(F.filter("findings", lambda f: f.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, BASE), F.sha2(said(base), 256).alias("base_sha256"), said(F.col("findings")).alias("spans"))


def _sql() -> str:
    """The same in DuckDB: RULES are written so that RE2 and java.util.regex agree on them."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    each = [
        f"""SELECT r, {k} AS ord, '{x.kind}' AS kind, i, length(gaps[i]) + length(hits[i]) AS step, length(hits[i]) AS len, length(parts[i]) >= {x.least} AS ok
        FROM (SELECT r, string_split_regex(t, {quoted(x.pattern)}) AS gaps, regexp_extract_all(t, {quoted(x.pattern)}) AS hits,
                     regexp_extract_all(t, {quoted(x.pattern)}, {x.measured}) AS parts, unnest(generate_series(1, len(hits))) AS i FROM docs)"""
        for k, x in enumerate(RULES)
    ]
    count = lambda kind: f"CAST(count(*) FILTER (WHERE kind = '{kind}') AS BIGINT) AS n_{kind}"
    said = "string_agg(kind || ':' || (stop - len) || ':' || stop, ',' ORDER BY stop - len, ord)"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
matches AS ({" UNION ALL ".join(each)}),
placed AS (SELECT *, CAST(sum(step) OVER (PARTITION BY r, ord ORDER BY i) AS BIGINT) AS stop FROM matches),
found AS (SELECT * FROM placed WHERE ok)
SELECT any_value(doc_id) AS doc_id, {", ".join(map(count, BASE))},
       sha256(coalesce({said} FILTER (WHERE kind IN ({", ".join(map(quoted, BASE))})), '')) AS base_sha256, coalesce({said}, '') AS spans
FROM docs LEFT JOIN found USING (r) GROUP BY r
"""


SQL = _sql()
