"""URL filters: rules on hosts and paths, else naive Bayes over segmented host and path words.

1. Every url is parsed; runs of letters in host and path are concatenated words.
2. A unigram model of all words of all pages (html and url paths) splits each distinct run by the Viterbi algorithm. Each run brings its
   own substrings, which are joined with the counts, so a task sees only the words that its runs can hold, and no word is left out
   by size: the model never comes to the driver.
3. A multinomial naive Bayes over hashed words is trained on all urls under weak labels: a url is bad if a word of its host is in the lexicon.
   There are no labels of urls, rules speak of languages, and pages of bad hosts read like any others. Counts are smoothed by ALPHA over
   the buckets that occur, so that a small class isn't swamped. What reaches the driver is at most BUCKETS counts.
4. Rules come first: the longest rule that fits decides; else the log odds, blocked if over 0. A score of 0 is allowed.

Cases: a null url, or one without ://, has an empty host and path and is judged by the prior alone. Only A-Z are lower-cased. Hosts may hold ports, user names or other
alphabets: those are tokens like any other. Words of any length count; those over MAX_WORD letters can't be part of a run. A run of over MAX_RUN letters (host labels have 63 at most) is
split piece by piece, so that urls of any length are read whole in bounded memory. Without bad (or good) urls nothing is blocked but by rules. Repeated pages are judged alike. Empty
tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialise, to_python


class UrlRule(NamedTuple):
    verdict: str  # block or allow
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The production rules.
RULES = (
    UrlRule("block", "com", "/en/"),
    UrlRule("allow", "example.com", "/en/7"),
    UrlRule("allow", "net", "/de/"),
    UrlRule("block", "example.net", "/de/8"),
    UrlRule("block", "org", "/es/"),
)

#: Host words that mark a url as bad in training.
LEXICON = ("ads", "adult", "bet", "bets", "casino", "escort", "loan", "malware", "payday", "phish", "pills", "poker", "porn", "sex", "spam", "track", "tracker", "viagra", "warez", "xxx")

MAX_WORD, MAX_RUN, BUCKETS, ALPHA = 64, 256, 1 << 16, 0.01
#: What the model counts a lexicon word at least, so that hosts are split at it.
LEXICON_COUNT = 100
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_TOKEN = re.compile(r"[a-z]+|[^\x00-\x7f]+|[0-9]+")


def split_url(url: str | None) -> tuple[str, str]:
    """host, path."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(_LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


class RuleSet:
    """Rules by host; a url looks up each suffix of its host."""

    def __init__(self, rules: tuple[UrlRule, ...]) -> None:
        self.by_host: dict[str, list[UrlRule]] = {}
        for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
            self.by_host.setdefault(r.host, []).append(r)

    def find(self, host: str, path: str) -> UrlRule | None:
        best, rest = None, host
        while True:
            for r in self.by_host.get(rest, ()):
                if path.startswith(r.path) and (best is None or len(r.name) > len(best.name)):
                    best = r
            _, dot, rest = rest.partition(".")
            if not dot:
                return best


class Segmenter:
    """The likeliest split of a string into words: Viterbi over a unigram model. Unknown words cost a digit a letter more."""

    def __init__(self, total: int) -> None:
        self.total = total + 1
        self.unknown = math.log(self.total)

    def split(self, text: str, counts: dict[str, int]) -> list[str]:
        """counts: those of the text's substrings. Of equal costs the longer last word wins."""
        cost = {w: -math.log(n / self.total) for w, n in counts.items()}
        best, back = [0.0], [0]
        for end in range(1, len(text) + 1):
            options = []
            for start in range(max(0, end - MAX_WORD), end):
                known = cost.get(text[start:end])
                options.append((best[start] + (known if known is not None else self.unknown + (end - start) * math.log(10)), start))
            least, start = min(options)
            best.append(least)
            back.append(start)
        words, end = [], len(text)
        while end:
            words.append(text[back[end] : end])
            end = back[end]
        return words[::-1]


def runs_of(part: str) -> list[str]:
    """Letters in runs of at most MAX_RUN, other alphabets as they are; any number is #."""
    found = _TOKEN.findall(part.translate(_LOWER))
    return ["#" if x[0].isdigit() else x[at : at + MAX_RUN] for x in found for at in (range(0, len(x), MAX_RUN) if x[0].isascii() and x[0].isalpha() else (0,))]



def unigrams(pages: DataFrame, *, url_col: str, html_col: str) -> DataFrame:
    """w, n: every word of all pages and how often it comes; the lexicon's words at least LEXICON_COUNT times."""
    text = F.concat_ws(" ", F.regexp_replace(F.coalesce(F.col(html_col).cast("string"), F.lit("")), r"<[^>]*>", " "), F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"://[^/?#]*([^?#]*)", 1))
    words = pages.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))).alias("w"))
    fixed = pages.sparkSession.createDataFrame([(w, 0, LEXICON_COUNT) for w in LEXICON], "w string, n long, least long")
    counted = words.groupBy("w").agg(F.count("*").alias("n"))
    return counted.withColumn("least", F.lit(0)).unionByName(fixed).groupBy("w").agg(F.greatest(F.sum("n"), F.max("least")).alias("n"))


def _parsed(pages: DataFrame, rules: tuple[UrlRule, ...], id_col: str, url_col: str) -> DataFrame:
    """row, id, host, path, rule, told (the rule's verdict), host_runs, path_runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ruled = RuleSet(rules)
        for batch in batches:
            parts = [split_url(url) for url in batch["url"].to_pylist()]
            fits = [ruled.find(host, path) for host, path in parts]
            texts = [[x[0] for x in parts], [x[1] for x in parts], [r and r.name for r in fits], [r and r.verdict for r in fits]]
            # user names are no part of the host's name
            words = [[runs_of(x[0].rpartition("@")[2]) for x in parts], [runs_of(x[1]) for x in parts]]
            yield pa.RecordBatch.from_arrays([batch["id"], *(pa.array(c, pa.string()) for c in texts), *(pa.array(c, pa.list_(pa.string())) for c in words)], ["id", "host", "path", "rule", "told", "host_runs", "path_runs"])

    kind = pages.schema[id_col].dataType.simpleString()
    rows = to_python(pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url")))
    found = rows.mapInArrow(run, f"id {kind}, host string, path string, rule string, told string, host_runs array<string>, path_runs array<string>")
    return materialise(found.withColumn("row", F.monotonically_increasing_id()), "urls")


def segmented(runs: DataFrame, words: DataFrame) -> DataFrame:
    """runs (run: distinct) and words (w, n) -> run, words: the likeliest split of each run."""
    total = words.agg(F.sum("n")).first()[0] or 0
    substrings = lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.length("run") - i + 1)), lambda k: F.substring("run", i, k))
    asked = runs.select("run", F.explode(F.flatten(F.transform(F.sequence(F.lit(1), F.length("run")), substrings))).alias("w"))
    # a row for each run and each word that it may hold
    known = asked.join(words, "w").groupBy("run").agg(F.collect_set(F.struct("w", "n")).alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(total)
        for batch in batches:
            found = [segmenter.split(x, {k["w"]: k["n"] for k in own or ()}) for x, own in zip(batch["run"].to_pylist(), batch["known"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["run"], pa.array(found, pa.list_(pa.string()))], ["run", "words"])

    return materialise(to_python(runs.join(known, "run", "left")).mapInArrow(run, "run string, words array<string>"), "segmented")


def _worded(parsed: DataFrame, words: DataFrame) -> DataFrame:
    """row, host_words, path_words, buckets, bad (by the lexicon)."""
    of = lambda k, column: F.transform(column, lambda r, i: F.struct(F.lit(k).alias("side"), i.alias("at"), r.alias("run")))
    sides = F.concat(of(0, "host_runs"), of(1, "path_runs"))
    runs = parsed.select("row", F.explode(sides).alias("x")).select("row", "x.*")
    split = segmented(runs.where(F.col("run").rlike("^[a-z]+$")).select("run").distinct(), words)
    each = runs.join(split, "run", "left").withColumn("words", F.coalesce("words", F.array("run")))
    lists = each.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("side", "at", "words"))).alias("all"))
    side = lambda k: F.flatten(F.transform(F.filter("all", lambda x: x.side == k), lambda x: x.words))
    named = lists.select("row", side(0).alias("host_words"), side(1).alias("path_words"))
    marked = F.concat(F.transform("host_words", lambda w: F.concat(F.lit("h:"), w)), F.transform("path_words", lambda w: F.concat(F.lit("p:"), w)))
    bucket = lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int")
    bad = F.arrays_overlap("host_words", F.array(*map(F.lit, LEXICON)))
    return materialise(named.select("row", "host_words", F.transform(marked, bucket).alias("buckets"), bad.alias("bad")), "url-words")


def train(worded: DataFrame, rows: int) -> tuple[np.ndarray, float]:
    """Log odds of bad against good for each bucket, 0 for those that never occur, and of the prior. rows: all urls, those without words too."""
    bad = worded.where("bad").count()
    if not 0 < bad < rows:
        return np.zeros(BUCKETS), -math.inf
    n = np.zeros((2, BUCKETS))
    for r in worded.select("bad", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count_if(~F.col("bad")).alias("good"), F.count_if("bad").alias("bad")).collect():
        n[:, r.bucket] = r.good, r.bad
    return log_odds(n), math.log(bad / (rows - bad))


def log_odds(n: np.ndarray) -> np.ndarray:
    """n: good and bad counts of each bucket."""
    seen = n.sum(0) > 0
    p = np.log((n + ALPHA) / (n.sum(1, keepdims=True) + ALPHA * seen.sum()))
    return np.where(seen, p[1] - p[0], 0.0)


def judge_urls(pages: DataFrame, *, rules: tuple[UrlRule, ...] = RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, words (of the host), score (log odds of bad)."""
    parsed = _parsed(pages, rules, id_col, url_col)
    worded = _worded(parsed, materialise(unigrams(pages, url_col=url_col, html_col=html_col), "words"))
    odds, prior = train(worded, parsed.count())

    def scoring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [prior + float(odds[np.array(own, np.int64)].sum()) for own in batch["buckets"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["row"], batch["host_words"], pa.array(scores, pa.float64())], ["row", "host_words", "score"])

    scored = worded.select("row", "host_words", "buckets").mapInArrow(scoring, "row long, host_words array<string>, score double")
    score = F.coalesce("score", F.lit(prior))
    verdict: Column = F.coalesce("told", F.when(score > 0, "block").otherwise("allow"))
    out = parsed.join(scored, "row", "left").select("id", "host", "path", "rule", verdict.alias("verdict"), F.coalesce(F.array_join("host_words", " "), F.lit("")).alias("words"), score.alias("score"))
    return out.withColumnRenamed("id", id_col)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url under RULES."""
    return judge_urls(load(spark, sf_dir, "pages"))
