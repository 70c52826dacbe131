"""Mixing sources to target weights by hierarchical budgets (DataFrame operators only).

Leaves are (domain, lang, source). The root's token budget flows down the tree: siblings share by weight, and what a
subtree cannot supply, even at max_epochs passes over it, goes to its siblings by their weights; only what all siblings
together lack goes back to the parent and so to its siblings. A leaf's documents come in one seeded order an epoch; a leaf takes
the prefix of that endless sequence that comes nearest to its budget: whole epochs, then a prefix of the next.

Budgets are computed level by level with windows over siblings, on tables with a row a node: sorted by room for a unit of weight, the siblings
that run short are a prefix. A leaf's prefix is found by token sums over ranges of the order's hash; only the range that holds the cut is
sorted. Documents are then chosen by comparing with the leaf's cut. Tables with a row a leaf are broadcast if they have at most BROADCAST_LEAVES
rows; else they are joined by the leaf, where the adaptive join may split a large one. Only the sum of all tokens and counts of leaves come to the driver.

Cases: tokens are runs of other than [\\x20\\x09-\\x0D]; a null or empty text has none and is taken with its epoch; a very long text is counted
whole and taken or left whole. Null parts of a leaf are leaves of their own, named null. Rows equal in id have one place in the order and are taken
together. Zero or absent weights get budget only as weight-less siblings of a shortage. Tokens that rounding down leaves go to siblings in order of
name. An empty table gives an empty result; other columns stay out of the way.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import load, materialise, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
#: Ranges of the order's hash in a leaf; each is sorted alone, and only where the cut lies.
ROWS_A_RANGE = 2_000
#: Leaves whose table is sent to all tasks: at some 100 bytes each, 10 MB at most.
BROADCAST_LEAVES = 100_000

LEAF = ["domain", "lang", "source"]
#: Weights of a node among its siblings: of domains, of languages, of sources.
Weights = tuple[Column, Column, Column]


def shared_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """nodes (parent's columns, name, amount: the parent's, room, weight: a whole number) with `got`: whole tokens that add up to the amount, or to all room.

    Siblings without weight share evenly what those with weight can't take.
    """
    family = Window.partitionBy(*parent)
    kin = Window.partitionBy(*parent, "idle")
    mine = nodes.withColumn("idle", F.col("weight") <= 0).withColumn("taken", F.coalesce(F.sum(F.when(~F.col("idle"), F.col("room"))).over(family), F.lit(0)))
    mine = mine.withColumn("here", F.when(F.col("idle"), F.greatest(F.col("amount") - F.col("taken"), F.lit(0))).otherwise(F.col("amount"))).withColumn("w", F.when(F.col("idle"), F.lit(1)).otherwise(F.col("weight")).cast("decimal(12,0)"))
    # at this scale different ratios of whole numbers differ
    ratio = F.col("room").cast("decimal(20,0)") / F.col("w")
    before = kin.orderBy("ratio", name).rowsBetween(Window.unboundedPreceding, -1)
    prior = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    mine = mine.withColumn("ratio", ratio).withColumn("left", F.col("here") - prior("room")).withColumn("w_left", (F.sum("w").over(kin) - prior("w")).cast("decimal(18,0)"))
    room, left = F.col("room").cast("decimal(19,0)"), F.col("left").cast("decimal(19,0)")
    mine = mine.withColumn("full", room * F.col("w_left") <= F.col("w") * left)
    mine = mine.withColumn("rest", (F.col("here") - F.coalesce(F.sum(F.when(F.col("full"), F.col("room"))).over(kin), F.lit(0))).cast("decimal(19,0)"))
    mine = mine.withColumn("w_open", F.sum(F.when(~F.col("full"), F.col("w"))).over(kin).cast("decimal(18,0)"))
    mine = mine.withColumn("part", F.when(F.col("full"), F.col("room")).otherwise(F.expr("(rest * cast(w as decimal(18,0))) div w_open")))
    mine = mine.withColumn("spare", F.col("rest") - F.sum(F.when(~F.col("full"), F.col("part"))).over(kin))
    nth = F.row_number().over(Window.partitionBy(*parent, "idle", "full").orderBy(name))
    got = (F.col("part") + F.when(~F.col("full") & (nth <= F.col("spare")), 1).otherwise(0)).cast("long")
    return mine.withColumn("got", got).select(*nodes.columns, "got")


def budgets(leaves: DataFrame, *, budget: int, weights: Weights) -> DataFrame:
    """leaves (domain, lang, source, room in tokens) -> their columns and budget."""
    scaled = [F.round(F.coalesce(w, F.lit(0)) * 1_000_000).cast("long") for w in weights]
    amount, above = leaves.select(F.lit(0).alias("root")).distinct().withColumn("got", F.lit(budget).cast("long")), ["root"]
    rooted = leaves.withColumn("root", F.lit(0))
    for k, name in enumerate(LEAF):
        sums = rooted.groupBy(*above, name).agg(F.sum("room").alias("room"))
        shares = sums.join(amount.withColumnRenamed("got", "amount"), above).withColumn("weight", scaled[k])
        above = [*above, name]
        amount = shared_out(shares, above[:-1], name).select(*above, "got")
    return leaves.join(amount.drop("root").withColumnRenamed("got", "budget"), LEAF)


def _small(table: DataFrame, leaves: int) -> DataFrame:
    return F.broadcast(table) if leaves <= BROADCAST_LEAVES else table


def _leafed(docs: DataFrame, domain: Column, seed: int) -> DataFrame:
    name = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    return docs.select(
        F.col("doc_id").alias("id"), name(domain).alias("domain"), name(F.col("lang")).alias("lang"), name(F.col("source")).alias("source"),
        F.regexp_count(text_or_empty("text"), F.lit(WORD)).cast("long").alias("n"),
    )


def place(id_col: Column, seed: int, epoch: Column | int) -> Column:
    """The seeded order of documents in an epoch: 63 bits."""
    return F.xxhash64(id_col, F.lit(seed), F.lit(epoch) if isinstance(epoch, int) else epoch).bitwiseAND(0x7FFFFFFFFFFFFFFF)


def plan_mix(docs: DataFrame, *, budget: float, weights: Weights, domain: Column, max_epochs: int, seed: int) -> tuple[DataFrame, DataFrame, int]:
    """counted (id, domain, lang, source, n), plan: leaf, budget, whole (epochs), cut_place, cut_id, closed (the cut's document is in), and how many leaves.

    budget: a share of all tokens. plan has one row a leaf of the tree.
    """
    counted = materialise(_leafed(docs, domain, seed), "mix-counted")
    leaf = LEAF
    totals = materialise(counted.groupBy(*leaf).agg(F.sum("n").alias("n"), F.count("*").alias("rows")), "mix-leaves")
    tokens, leaves = totals.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    goal = int(Fraction(budget).limit_denominator(10**6) * tokens)
    given = budgets(totals.withColumn("room", F.col("n") * max_epochs), budget=goal, weights=weights)
    whole = F.when(F.col("n") > 0, F.expr("budget div n")).otherwise(1)
    rest = F.when(F.col("n") > 0, F.col("budget") % F.col("n")).otherwise(0)
    # a power of two: about ROWS_A_RANGE rows in each
    ranges = F.greatest(F.lit(1), F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(F.floor(F.col("rows") / ROWS_A_RANGE), F.lit(1)))) + 1) * (F.col("rows") >= ROWS_A_RANGE).cast("int")).cast("long")
    targets = materialise(given.select(*leaf, "budget", whole.cast("long").alias("whole"), rest.cast("long").alias("rest"), ranges.alias("ranges")), "mix-targets")
    placed = counted.where("n > 0").join(_small(targets.where("rest > 0"), leaves), leaf).withColumn("place", place(F.col("id"), seed, F.col("whole")))
    placed = placed.withColumn("range", F.floor(F.col("place") / (F.lit(2.0**63) / F.col("ranges"))))
    before = Window.partitionBy(*leaf).orderBy("range")
    ranges = placed.groupBy(*leaf, "range").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(before))
    # the range in which the sum reaches the rest: one a leaf
    at = ranges.join(_small(targets, leaves), leaf).where("upto >= rest AND upto - n < rest").select(*leaf, "range", F.col("upto").alias("range_upto"), F.col("n").alias("range_n"))
    inside = placed.join(_small(at, leaves), [*leaf, "range"])
    order = Window.partitionBy(*leaf, "range").orderBy("place", F.asc_nulls_first("id"))
    upto = F.col("range_upto") - F.col("range_n") + F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    # the prefix nearest to the rest: a document is in if at least half of it fits; if none of the range fits, the cut is before its first
    fits = F.when(2 * upto - F.col("n") <= 2 * F.col("rest"), F.struct("place", "id"))
    chosen = inside.withColumn("fits", fits).groupBy(*leaf).agg(F.max("fits").alias("last"), F.min("place").alias("first"))
    cut = chosen.select(*leaf, F.col("last").isNotNull().alias("closed"), F.coalesce("last", F.struct(F.col("first").alias("place"), F.lit(None).cast(docs.schema["doc_id"].dataType).alias("id"))).alias("cut"))
    plan = targets.join(cut, leaf, "left").select(*leaf, "budget", "whole", F.col("cut.place").alias("cut_place"), F.col("cut.id").alias("cut_id"), "closed")
    return counted, materialise(plan, "mix-plan"), leaves


def mix(docs: DataFrame, *, budget: float, weights: Weights, domain: Column, max_epochs: int, seed: int) -> DataFrame:
    """id, domain, lang, source, n (tokens), copies: how often each row of docs comes in the mixture, 0 included."""
    counted, plan, leaves = plan_mix(docs, budget=budget, weights=weights, domain=domain, max_epochs=max_epochs, seed=seed)
    return counted.join(_small(plan, leaves), LEAF).withColumn("copies", _copies(seed)).select("id", "domain", "lang", "source", "n", "budget", "copies")


def mixed_rows(docs: DataFrame, *, budget: float, weights: Weights, domain: Column, max_epochs: int, seed: int) -> DataFrame:
    """The mixture itself: each row of docs, with all its columns, as often as mix() says. Texts are not shuffled."""
    _, plan, leaves = plan_mix(docs, budget=budget, weights=weights, domain=domain, max_epochs=max_epochs, seed=seed)
    mine = {"_mix_domain": domain, "_mix_lang": F.col("lang"), "_mix_source": F.col("source")}
    rows = docs.select(F.struct(*docs.columns).alias("_mix_row"), F.col("doc_id").alias("id"), *(F.coalesce(c.cast("string"), F.lit("null")).alias(k) for k, c in mine.items()))
    renamed = plan.select(*(F.col(k.removeprefix("_mix_")).alias(k) for k in mine), "whole", "cut_place", "cut_id", "closed")
    chosen = rows.join(_small(renamed, leaves), [*mine]).select("_mix_row", _copies(seed).alias("copies")).where("copies > 0")
    return chosen.select("_mix_row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("epoch")).select("_mix_row.*")


def _copies(seed: int) -> Column:
    """Whole epochs, and one more for those up to the cut. Without a cut there is no rest to take."""
    mine = place(F.col("id"), seed, F.col("whole"))
    inside = (mine < F.col("cut_place")) | ((mine == F.col("cut_place")) & F.col("closed") & F.coalesce(F.col("id") <= F.col("cut_id"), F.col("id").isNull()))
    return F.col("whole") + F.when(F.coalesce(inside, F.lit(False)), 1).otherwise(0)


#: The production mixture: sources in four domains; languages by weight; sources evenly.
DOMAIN_WEIGHTS = {"d0": 0.4, "d1": 0.25, "d2": 0.2, "d3": 0.15}
LANG_WEIGHTS = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}
BUDGET, MAX_EPOCHS, SEED = 0.9, 2, 20_240_611


def production_domain() -> Column:
    """src0-4 are d0, src5-9 d1, src10-14 d2, all others d3."""
    number = F.try_to_number(F.regexp_extract(F.coalesce(F.col("source").cast("string"), F.lit("")), r"^src([0-9]{1,9})$", 1), F.lit("999999999"))
    return F.when(number < 5, "d0").when(number < 10, "d1").when(number < 15, "d2").otherwise("d3")


def production_weights() -> Weights:
    """Domains and languages by DOMAIN_WEIGHTS and LANG_WEIGHTS, others without weight; sources alike."""
    of = lambda table, c: F.create_map(*(F.lit(x) for kv in table.items() for x in kv))[F.col(c)]
    return of(DOMAIN_WEIGHTS, "domain"), of(LANG_WEIGHTS, "lang"), F.lit(1.0)


def production() -> dict:
    """Parameters of the production mixture."""
    return {"budget": BUDGET, "weights": production_weights(), "domain": production_domain(), "max_epochs": MAX_EPOCHS, "seed": SEED}


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents with its leaf, tokens, the leaf's budget and its copies in the production mixture."""
    out = mix(load(spark, sf_dir, "documents"), **production())
    return out.select(F.col("id").alias("doc_id"), "domain", "lang", "source", F.col("n").alias("n_tokens"), F.col("budget").alias("leaf_budget"), "copies", (F.col("n") * F.col("copies")).alias("mixed_tokens"))
