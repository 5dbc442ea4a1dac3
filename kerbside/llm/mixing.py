"""Mixing sources to target weights by hierarchical budgeting. DataFrame functions only.

Leaves are (domain, language, source). Each node of the tree has a weight among its siblings and a
capacity: the tokens below it times the epochs allowed. The budget goes down the tree; at each node it
is filled into the children in proportion to their weights, but none gets more than its capacity, and
what a child cannot take goes to its siblings first. As a node's budget never exceeds its capacity, only
what a whole family cannot take is left for the families beside its parent.

A leaf with budget t and T tokens is read t div T times whole; of the next epoch it takes the prefix of
t mod T tokens in a seeded order of its documents (md5 of seed, epoch and doc_id), the last document in
part. All arithmetic is on integers.

The prefix is found without sorting a leaf in one task: documents fall into about sqrt(documents of the
leaf) buckets by the leading digits of their hash; bucket totals give the one bucket where the prefix
ends, and only inside it documents are ordered.

Tokens are runs of characters other than white space. Definitions: null or blank text has no tokens and
is never selected (a leaf of such documents has capacity 0); null domain, language or source is the
leaf ``''``; nodes without a given weight weigh ``default_weight``; weight 0 gets nothing unless no
sibling has a weight; repeated rows count each; an empty table gives no rows. Ties of the seeded order
go to the smaller doc_id, then to the document with fewer tokens. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import shield, stored

LEVELS = ("domain", "lang", "source")
SEED = 17
MAX_EPOCHS = 4
DEFAULT_WEIGHT = 10
#: White space of token boundaries.
TOKEN = r"[^ \t\n\r\f]+"
#: Bits of the seeded hash that choose a bucket.
HASH_DIGITS = 8


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def weight_of(path: Column, weights: Mapping[str, int], default: int) -> Column:
    """``weights`` by node path ('web', 'web/en', 'web/en/src0')."""
    if not weights:
        return F.lit(default).cast("long")
    table = F.create_map(*[F.lit(x) for k, v in sorted(weights.items()) for x in (k, int(v))])
    return F.coalesce(F.try_element_at(table, path), F.lit(default)).cast("long")


def fill(nodes: DataFrame, family: Sequence[str], name: str) -> DataFrame:
    """Budget of each node from its family's ``budget``: ``nodes`` has family columns, ``name``, capacity,
    weight and budget. The smallest capacities for their weight are met first; when the fair share of the
    others falls below their capacities, they divide what is left by cumulative rounding, so that it adds
    up."""
    siblings = Window.partitionBy(*family) if family else Window.partitionBy(F.lit(0))
    # a family without weights shares equally
    nodes = nodes.withColumn("weight", F.when(F.sum("weight").over(siblings) == 0, 1).otherwise(F.col("weight")))
    nodes = nodes.withColumn("capacity", F.when(F.col("weight") == 0, 0).otherwise(F.col("capacity")))
    # capacity by weight, exactly: whole part and remainder
    at = [F.expr("capacity div greatest(weight, 1)"), F.expr("(capacity % greatest(weight, 1)) / greatest(weight, 1)"),
          F.col(name)]
    by_ratio = siblings.orderBy(*at)
    upto, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    ranked = (nodes
              .withColumn("met", F.coalesce(F.sum("capacity").over(upto), F.lit(0)))
              .withColumn("weight_left", F.sum("weight").over(after)))
    # a node is met in full while capacity * weights left <= weight * budget left
    full = (F.col("capacity").cast("decimal(38,0)") * F.col("weight_left")
            <= F.col("weight").cast("decimal(38,0)") * F.greatest(F.col("budget") - F.col("met"), F.lit(0)))
    ranked = ranked.withColumn("full", full)
    open_rows = siblings.orderBy(*at).rowsBetween(Window.unboundedPreceding, 0)
    ranked = (ranked
              .withColumn("open_weight", F.when(F.col("full"), 0).otherwise(F.col("weight")))
              .withColumn("share_left", F.col("budget") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0))
                          .over(siblings))
              .withColumn("open_sum", F.sum("open_weight").over(siblings))
              .withColumn("open_upto", F.sum("open_weight").over(open_rows)))

    def rounded(weight: str) -> Column:
        return F.expr(f"cast(greatest(share_left, 0) as decimal(20,0)) * cast({weight} as decimal(18,0)) "
                      "div greatest(open_sum, 1)")

    given = F.when(F.col("full"), F.col("capacity")).otherwise(
        rounded("open_upto") - rounded("open_upto - open_weight"))
    return ranked.withColumn("given", given)


def budgets(leaves: DataFrame, budget: int | Column, weights: Mapping[str, int], max_epochs: int = MAX_EPOCHS,
            default_weight: int = DEFAULT_WEIGHT) -> DataFrame:
    """``target`` tokens of every leaf; ``leaves`` has the levels and ``tokens``. The budget may be a column
    over the total (``F.col('total')``)."""
    paths = [F.concat_ws("/", *LEVELS[:k + 1]) for k in range(len(LEVELS))]
    tree = leaves.withColumn("capacity", (F.col("tokens") * max_epochs).cast("long"))
    budget = F.lit(budget).cast("long") if isinstance(budget, int) else budget.cast("long")
    above = tree.groupBy().agg(F.sum("tokens").alias("total"), F.sum("capacity").alias("all_capacity")).select(
        F.least(budget, F.col("all_capacity")).alias("budget"))
    family: list[str] = []
    level = None
    for k, name in enumerate(LEVELS):
        here = tree.groupBy(*LEVELS[:k + 1]).agg(F.sum("capacity").alias("capacity")).withColumn(
            "weight", weight_of(paths[k], weights, default_weight))
        if level is None:  # one row of totals for the first level's few nodes
            here = here.withColumn("_one", F.lit(1)).join(above.withColumn("_one", F.lit(1)), "_one").drop("_one")
        else:
            here = here.join(level, family)
        level = fill(here, family, name).select(*family, name, F.col("given").alias("budget"))
        family.append(name)
    return leaves.join(level.withColumnRenamed("budget", "target"), list(LEVELS))


def seeded(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def levelled(docs: DataFrame, domain: Column) -> DataFrame:
    """``docs`` with its levels and tokens as ``_mix_*`` columns; documents without tokens go."""
    marked = docs.withColumn("_mix_tokens", token_count(docs["text"]))
    for c, value in zip(LEVELS, (domain, F.col("lang"), F.col("source"))):
        marked = marked.withColumn(f"_mix_{c}", F.coalesce(value.cast("string"), F.lit("")))
    return marked.where("_mix_tokens > 0")


#: Columns that planning reads.
NARROW = ("doc_id", "_mix_tokens", *(f"_mix_{c}" for c in LEVELS))
LEAF = [f"_mix_{c}" for c in LEVELS]


def bucketed(narrow: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Documents of leaves that read part of an epoch, with their hash in it and their bucket."""
    digits = F.conv(F.substring("_mix_hash", 1, HASH_DIGITS), 16, 10).cast("long")
    return (narrow.join(plan, LEAF)
            .withColumn("_mix_hash", F.when(F.col("_mix_rest") > 0, seeded(seed, F.col("_mix_epochs"), F.col("doc_id"))))
            .withColumn("_mix_bucket", F.shiftright(digits * F.col("_mix_buckets"), 4 * HASH_DIGITS)))


def make_plan(narrow: DataFrame, budget: int | Column, weights: Mapping[str, int], max_epochs: int, seed: int,
              default_weight: int) -> tuple[DataFrame, DataFrame]:
    """A row per leaf that is read, and a row per bucket of its last epoch that the prefix reaches."""
    leaves = narrow.groupBy(*LEAF).agg(F.sum("_mix_tokens").alias("tokens"), F.count("*").alias("docs"))
    leaves = leaves.select(*[F.col(f"_mix_{c}").alias(c) for c in LEVELS], "tokens", "docs")
    plan = stored(budgets(leaves, budget, weights, max_epochs, default_weight).where("target > 0")
                  .select(*[F.col(c).alias(f"_mix_{c}") for c in LEVELS],
                          F.expr("target div tokens").alias("_mix_epochs"),
                          F.expr("target % tokens").alias("_mix_rest"),
                          F.ceil(F.sqrt("docs")).cast("long").alias("_mix_buckets")), "mixing-plan")
    in_order = Window.partitionBy(*LEAF).orderBy("_mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(bucketed(narrow, plan, seed).where("_mix_rest > 0").groupBy(*LEAF, "_mix_bucket")
                   .agg(F.sum("_mix_tokens").alias("_mix_in"), F.first("_mix_rest").alias("_mix_of"))
                   .withColumn("_mix_base", F.coalesce(F.sum("_mix_in").over(in_order), F.lit(0)))
                   .where("_mix_base < _mix_of").drop("_mix_of"), "mixing-buckets")
    return plan, bases


def apply_plan(marked: DataFrame, plan: DataFrame, bases: DataFrame, seed: int) -> DataFrame:
    """Rows that the mixture reads, with ``_mix_epoch`` and ``_mix_take`` tokens. Only documents of the one
    bucket of each leaf where its prefix ends are shuffled and ordered."""
    keyed = bucketed(marked, plan, seed).join(bases, [*LEAF, "_mix_bucket"], "left")
    inside = F.col("_mix_base") + F.col("_mix_in") <= F.col("_mix_rest")
    # whole epochs, and one more for documents that the prefix holds in full
    times = F.col("_mix_epochs") + F.when(inside, 1).otherwise(0)
    whole = (keyed.withColumn("_mix_times", times).where("_mix_times > 0")
             .withColumn("_mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_mix_times") - 1)))
             .withColumn("_mix_take", F.col("_mix_tokens")).drop("_mix_times"))
    before = (Window.partitionBy(*LEAF, "_mix_bucket").orderBy("_mix_hash", "doc_id", "_mix_tokens")
              .rowsBetween(Window.unboundedPreceding, -1))
    edge = (bucketed(marked, plan, seed).join(bases, [*LEAF, "_mix_bucket"])
            .where("_mix_base + _mix_in > _mix_rest")
            .withColumn("_mix_epoch", F.col("_mix_epochs"))
            .withColumn("_mix_start", F.col("_mix_base") + F.coalesce(F.sum("_mix_tokens").over(before), F.lit(0)))
            .where("_mix_start < _mix_rest")
            .withColumn("_mix_take", F.least(F.col("_mix_tokens"), F.col("_mix_rest") - F.col("_mix_start")))
            .drop("_mix_start"))
    return whole.unionByName(edge)


def select_tokens(docs: DataFrame, domain: Column, budget: int | Column, weights: Mapping[str, int],
                  max_epochs: int = MAX_EPOCHS, seed: int = SEED, default_weight: int = DEFAULT_WEIGHT) -> DataFrame:
    """Which tokens the mixture reads: doc_id, domain, lang, source, doc_tokens, epoch, take_tokens (the first
    ones of the document)."""
    narrow = stored(levelled(docs.select("doc_id", "text", "lang", "source"), domain).select(*NARROW),
                    "mixing-documents")
    plan, bases = make_plan(narrow, budget, weights, max_epochs, seed, default_weight)
    return apply_plan(narrow, plan, bases, seed).select(
        "doc_id", *[F.col(f"_mix_{c}").alias(c) for c in LEVELS], F.col("_mix_tokens").alias("doc_tokens"),
        F.col("_mix_epoch").alias("epoch"), F.col("_mix_take").cast("long").alias("take_tokens"))


def mix_documents(docs: DataFrame, domain: Column, budget: int | Column, weights: Mapping[str, int],
                  max_epochs: int = MAX_EPOCHS, seed: int = SEED, default_weight: int = DEFAULT_WEIGHT) -> DataFrame:
    """The mixture's documents with all columns of ``docs``, once for each epoch that reads them. A document
    cut at its leaf's budget keeps its first tokens, joined by single spaces, and its length is set anew."""
    plain, back = shield(docs, "doc_id", "text", "lang", "source", "n_chars")
    marked = levelled(plain, domain)
    narrow = stored(marked.select(*NARROW), "mixing-documents")
    plan, bases = make_plan(narrow, budget, weights, max_epochs, seed, default_weight)
    chosen = apply_plan(marked, plan, bases, seed)
    words = F.split(F.trim(F.regexp_replace("text", r"[ \t\n\r\f]+", " ")), " ")
    whole = F.col("_mix_take") >= F.col("_mix_tokens")
    cut = F.when(whole, F.col("text")).otherwise(F.array_join(F.slice(words, F.lit(1), F.col("_mix_take").cast("int")), " "))
    return back(chosen.withColumns({
        "text": cut, "n_chars": F.when(whole, F.col("n_chars")).otherwise(F.length(cut).cast(plain.schema["n_chars"].dataType))}))
