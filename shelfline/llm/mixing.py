"""Mixing sources to target weights by hierarchical budgeting.

A token budget runs down a tree domain -> language -> source. At each node
it is shared among the children by their weights; a child that cannot use
its share (it has only ``max_epochs`` times its tokens) gives the rest to
its siblings, and only what all siblings together cannot use was already
kept back one level above. In closed form each node's children get
``min(capacity, level * weight)`` with one common level, found with window
sums over the children sorted by capacity / weight.

A leaf with budget B and T tokens takes ``B // T`` whole epochs and a token
prefix of the next one. Each epoch orders the leaf by a seeded MD5 of the
id; the prefix ends with the first document that reaches the budget. The
cut is found on token sums of 256 buckets, then of 256 buckets inside the
one that holds the cut, then on that bucket's rows, and is applied row by
row: texts are never shuffled and no leaf meets in one task, even if it
holds a third of all rows.

Defined cases: a null language or source is the leaf named ``(none)``; a
null text has no tokens; documents without tokens go with their place in
the order; rows with the same id share their place and are taken together;
leaves without a positive weight, or a tree without tokens, get no budget.
An empty table gives no rows. Columns of ``docs`` named like an added one
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import carried, hex_long, stored, with_small_side, words

TREE = ["domain", "lang", "source"]
ORDER_DIGITS = 15  # 60 bits
STEP_DIGITS = 2  # 256 order buckets at each step of the search for a cut
STEPS = 2

# Production parameters of the registered query: integer weights of the
# children below each node of the tree; others count as OTHER_WEIGHT.
DOMAINS = ["web", "books", "code", "forums"]
DOMAIN_WEIGHTS = {"web": 30, "books": 40, "code": 20, "forums": 10}
LANG_WEIGHTS = {"en": 50, "de": 20, "fr": 15, "es": 15}
OTHER_WEIGHT = 5
BUDGET_PERCENT = 80
MAX_EPOCHS = 2
SEED = "mix-1"


def domain_of_source(source: Column) -> Column:
    """Domain of a source by the number at the end of its name, mod 4."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]{1,9})$", 1)
    names = F.array(*[F.lit(d) for d in DOMAINS])
    return F.when(number != "", F.element_at(names, (number.try_cast("int") % len(DOMAINS)) + 1)) \
        .otherwise(F.lit("other"))


def _weight(col: str, weights: dict[str, int] | None) -> Column:
    if not weights:
        return F.lit(1).cast("long")
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    return F.coalesce(F.element_at(table, F.col(col)), F.lit(OTHER_WEIGHT)).cast("long")


def leaf_budgets(leaves: DataFrame, budget: int, weights: list[dict[str, int] | None],
                 max_epochs: int) -> DataFrame:
    """Budget of every leaf with a positive weight and tokens.

    ``leaves`` has the TREE columns and ``tokens`` (one row per leaf).
    """
    level = leaves.withColumn("cap", F.col("tokens") * max_epochs).where("cap > 0")
    for col, w in zip(TREE, weights):
        level = level.withColumn(f"w_{col}", _weight(col, w)).where(F.col(f"w_{col}") > 0)
    # Capacities go up the tree, budgets come down.
    nodes = {2: level}
    for depth in (1, 0):
        keep = TREE[:depth + 1]
        nodes[depth] = nodes[depth + 1].groupBy(*keep, *[f"w_{c}" for c in keep]).agg(F.sum("cap").alias("cap"))
    here = nodes[0].withColumn("b_parent", F.lit(float(budget)))
    for depth, col in enumerate(TREE):
        up = TREE[:depth]
        if depth:
            here = nodes[depth].join(here.select(*up, F.col("b").alias("b_parent")), up)
        w = F.col(f"w_{col}")
        by = Window.partitionBy(*up)
        order = by.orderBy(F.col("cap") / w, F.col(col))
        prior = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        rest = F.sum(w).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        # The candidate level grows while children are full, then falls: its
        # greatest value is the common level.
        here = here.withColumn("lam", (F.col("b_parent") - prior) / rest)
        here = here.withColumn("lam", F.max("lam").over(by))
        here = here.withColumn("b", F.least(F.col("cap").cast("double"), F.col("lam") * w))
    return here.select(*TREE, F.floor("b").cast("long").alias("leaf_budget"))


def _order(seed: str, epoch: Column, doc_id: Column) -> Column:
    key = F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"),
                   F.coalesce(doc_id.cast("string"), F.lit("")))
    return hex_long(F.md5(key.cast("binary")), 1, ORDER_DIGITS)


def _cuts(slim: DataFrame, plan: DataFrame, n_leaves: int, seed: str) -> DataFrame:
    """For each leaf with a rest, the greatest order taken by its prefix."""
    small = lambda df: with_small_side(df, n_leaves, 100_000)  # noqa: E731
    before = Window.partitionBy(*TREE).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rest = plan.where("rest > 0").select(*TREE, "whole", F.col("rest").alias("left"))
    ordered = (slim.join(small(rest), TREE)
               .withColumn("order", _order(seed, F.col("whole"), F.col("doc_id"))))
    for step in range(1, STEPS + 2):
        digits = step * STEP_DIGITS if step <= STEPS else ORDER_DIGITS
        sums = (ordered.withColumn("place", F.shiftright("order", 4 * (ORDER_DIGITS - digits)))
                .groupBy(*TREE, "place", "left").agg(F.sum("n_tokens").alias("n"))
                .withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
                .where("base < left"))
        if digits == ORDER_DIGITS:
            return sums.groupBy(*TREE).agg(F.max("place").alias("cut"))
        edge = sums.where("base + n >= left").select(*TREE, F.col("place").alias("edge"), "base")
        ordered = (ordered.join(small(edge), TREE)
                   .where(F.shiftright("order", 4 * (ORDER_DIGITS - digits)) == F.col("edge"))
                   .withColumn("left", F.col("left") - F.col("base")).drop("edge", "base"))


def mix(docs: DataFrame, budget: int | None = None, domain_weights: dict | None = None,
        lang_weights: dict | None = None, source_weights: dict | None = None,
        max_epochs: int = MAX_EPOCHS, seed: str = SEED, domain: Column | None = None,
        tokens: Column | None = None) -> DataFrame:
    """The mixed corpus: the columns of ``docs`` plus ``domain``,
    ``n_tokens``, ``leaf_budget`` and ``epoch``; one row per document and
    epoch in which it is taken.

    ``budget`` is in tokens (default: BUDGET_PERCENT of all tokens).
    """
    lang, source = (F.coalesce(F.col(c), F.lit("(none)")) for c in ("lang", "source"))
    path = F.struct((domain if domain is not None else domain_of_source(F.col("source"))).alias("domain"),
                    lang.alias("lang"), source.alias("source"))
    n_tokens = tokens if tokens is not None else F.size(words(F.col("text"))).cast("long")
    added = ["domain", "n_tokens", "leaf_budget", "epoch"]
    full = docs.select(F.struct(*carried(docs, added)).alias("doc"), F.col("doc_id").alias("id"),
                       path.alias("path"), n_tokens.alias("n_tokens"))
    # The only pass that is grouped: ids, path and count, no text.
    slim = stored(full.select(F.col("id").alias("doc_id"), "path.*", "n_tokens"), "mix-slim")
    leaves = stored(slim.groupBy(*TREE).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    n_leaves, total = leaves.agg(F.count("*"), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    if budget is None:
        budget = total * BUDGET_PERCENT // 100
    plan = leaves.join(leaf_budgets(leaves, budget,
                                    [DOMAIN_WEIGHTS if domain_weights is None else domain_weights,
                                     LANG_WEIGHTS if lang_weights is None else lang_weights,
                                     source_weights], max_epochs), TREE)
    whole = F.least(F.floor(F.col("leaf_budget") / F.col("tokens")), F.lit(max_epochs))
    plan = stored(plan.withColumn("whole", whole).withColumn(
        "rest", F.when(F.col("whole") < max_epochs,
                       F.col("leaf_budget") - F.col("whole") * F.col("tokens")).otherwise(0)), "mix-plan")
    decided = stored(plan.join(_cuts(slim, plan, n_leaves, seed), TREE, "left").select(
        F.struct(*TREE).alias("path"), "leaf_budget", "whole",
        F.coalesce("cut", F.lit(-1)).alias("cut")), "mix-decided")
    taken = F.col("whole") + (_order(seed, F.col("whole"), F.col("id")) <= F.col("cut")).cast("int")
    return (full.join(with_small_side(decided, n_leaves, 100_000), "path")
            .withColumn("taken", taken).where("taken > 0")
            .select("doc.*", "path.domain", "n_tokens", "leaf_budget",
                    F.explode(F.sequence(F.lit(0), (F.col("taken") - 1).cast("int"))).alias("epoch")))


def _oracle_level(depth: int) -> str:
    col, up = TREE[depth], ", ".join(TREE[:depth])
    part = f"PARTITION BY {up} " if up else ""
    source = (f"SELECT *, {{budget}}::DOUBLE AS b_parent FROM n{depth}, total" if not depth else
              f"SELECT n{depth}.*, p.b AS b_parent FROM n{depth} JOIN b{depth - 1} p USING ({up})")
    return f"""
s{depth} AS (SELECT *, (b_parent - coalesce(sum(cap) OVER ({part}ORDER BY cap / w_{col}, {col}
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w_{col}) OVER ({part}ORDER BY cap / w_{col}, {col}
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lam FROM ({source})),
b{depth} AS (SELECT *, least(cap::DOUBLE, m * w_{col}) AS b
  FROM (SELECT *, max(lam) OVER ({part}) AS m FROM s{depth})),"""


def _oracle() -> str:
    case = lambda col, w: (f"CASE {col} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in w.items())  # noqa: E731
                           + f" ELSE {OTHER_WEIGHT} END")
    levels = "".join(_oracle_level(d) for d in range(3)).replace(
        "{budget}", f"(t * {BUDGET_PERCENT} // 100)")
    order = f"('0x' || substr(md5('{SEED}:' || whole || ':' || coalesce(doc_id::VARCHAR, '')), 1, {ORDER_DIGITS}))::BIGINT"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
    CASE regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) WHEN '' THEN 'other' ELSE
      ({DOMAINS})[1 + regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1)::INT % {len(DOMAINS)}] END AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^ 	-]+'))::BIGINT AS n_tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY ALL),
total AS (SELECT sum(tokens)::BIGINT AS t FROM leaf),
n2 AS (SELECT *, tokens * {MAX_EPOCHS} AS cap, {case('domain', DOMAIN_WEIGHTS)} AS w_domain,
    {case('lang', LANG_WEIGHTS)} AS w_lang, 1 AS w_source FROM leaf WHERE tokens > 0),
n1 AS (SELECT domain, lang, w_domain, w_lang, sum(cap)::BIGINT AS cap FROM n2 GROUP BY ALL),
n0 AS (SELECT domain, w_domain, sum(cap)::BIGINT AS cap FROM n1 GROUP BY ALL),{levels}
plan AS (SELECT domain, lang, source, tokens, floor(b)::BIGINT AS leaf_budget,
    least(floor(b)::BIGINT // tokens, {MAX_EPOCHS}) AS whole FROM b2),
o AS (SELECT d.*, leaf_budget, whole,
    CASE WHEN whole < {MAX_EPOCHS} THEN leaf_budget - whole * tokens ELSE 0 END AS rest, {order} AS ord
  FROM d JOIN plan USING (domain, lang, source)),
p AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY ord
    RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM o)
SELECT doc_id, domain, lang, source, n_tokens, leaf_budget,
  unnest(range(whole + CASE WHEN prior < rest THEN 1 ELSE 0 END))::INT AS epoch FROM p
"""


ORACLE_SQL = _oracle()
