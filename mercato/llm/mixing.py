"""Mixing sources to target weights by hierarchical budgeting.

Domains, their languages and the languages' sources form a tree.  A budget of
tokens flows down it in proportion to weights; what a node can't supply (its
documents times the epochs allowed) is taken up by its siblings, again by weight,
and only what they all together can't supply goes to the siblings of their parent.
Allotted from the top with each subtree's supply as its limit, that is one pass
per level: children in order of supply per weight fill up until the rest can take
its full share.

A leaf then gives whole epochs and a prefix of one more, in that epoch's seeded
order, up to its budget.  The order is by MD5 of seed, epoch and id; token sums per
leaf and leading hex digits place the cut, so only the documents of one bucket per
leaf are ranked, and no leaf is ever sorted whole.

DataFrame functions only; whole numbers throughout, so every engine agrees.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import WORD_CLASS, materialise

LEVELS = ("domain", "lang", "source")
DIGITS = 3  # leading hex digits of the order: 4,096 buckets per leaf


@dataclass(frozen=True)
class Mix:
    """Weights are whole numbers; a name that isn't listed has weight 1 times the
    level's default."""
    budget_permille: int  # of the tokens of the table
    epochs: int = 1
    seed: int = 20261
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    default: int = 10

    def weight(self, level: str) -> Column:
        out = F.lit(self.default)
        for name, w in self.weights.get(level, {}).items():
            out = F.when(F.col(f"__mx_{level}") == name, F.lit(w)).otherwise(out)
        return out.cast("decimal(38,0)")


#: The tables have no domain column: sources src0-src4 count as web, src5-src9 as
#: books, all others as forum.
PRODUCTION = Mix(budget_permille=900, epochs=2, weights={
    "domain": {"web": 50, "books": 30, "forum": 20}, "lang": {"en": 60, "de": 15, "fr": 15, "es": 10},
    "source": {"src0": 40}})


def domain_of(source: Column) -> Column:
    n = F.regexp_extract(source, "^src([0-9]{1,6})$", 1)
    return (F.when(n == "", "forum").when(n.cast("int") < 5, "web").when(n.cast("int") < 10, "books")
            .otherwise("forum"))


def _leaves(docs: DataFrame, mix: Mix, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with domain, language, source (null: empty), tokens and id as text.  A column
    named ``domain`` is the domain; without one it is derived from the source's name.  No
    other column plays a part; whole texts are counted, however long."""
    def has(name):
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) if name in docs.columns else F.lit("")

    source = has("source")
    domain = has("domain") if "domain" in docs.columns else domain_of(source)
    words = F.size(F.regexp_extract_all(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit(f"({WORD_CLASS})"), 1))
    return docs.select("*", domain.alias("__mx_domain"), has("lang").alias("__mx_lang"),
                       source.alias("__mx_source"), words.cast("long").alias("__mx_tokens"),
                       F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("__mx_id"))


def order_key(mix: Mix, epoch: Column) -> Column:
    """Place of a document in an epoch's seeded order."""
    return F.md5(F.concat_ws(":", F.lit(str(mix.seed)), epoch.cast("string"), F.col("__mx_id")).cast("binary"))


def fill(nodes: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Allot each parent's ``quota`` among its children (cap, w, child): adds
    ``share``.  A child is full if its cap is at most its part, by weight, of what
    the children before it (in order of cap per weight) have left; the rest share
    what the full ones leave, rounded so that the shares add up."""
    up = [F.col(p) for p in parent]
    by_ratio = Window.partitionBy(*up).orderBy((F.col("cap") / F.col("w")).cast("double"), child)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(*up)
    zero = F.lit(0).cast("decimal(38,0)")
    n = (nodes.withColumn("left", F.col("quota") - F.coalesce(F.sum("cap").over(before), zero))
         .withColumn("w_left", F.sum("w").over(after)))
    # cap / w grows along the order, so the full children come first
    n = n.withColumn("full", F.col("cap") * F.col("w_left") <= F.col("left") * F.col("w"))
    n = (n.withColumn("rest", F.col("quota") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), zero))
         .withColumn("w_rest", F.sum(F.when(~F.col("full"), F.col("w"))).over(whole))
         .withColumn("w_upto", F.sum(F.when(~F.col("full"), F.col("w")).otherwise(0)).over(
             by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    return n.withColumn("share", F.when(F.col("full"), F.col("cap")).otherwise(F.expr(
        "CAST(rest * w_upto div w_rest - rest * (w_upto - w) div w_rest AS decimal(38,0))"))).drop(
        "left", "w_left", "full", "rest", "w_rest", "w_upto")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, tokens, quota): one row per leaf of the tree."""
    names = [f"__mx_{level}" for level in LEVELS]
    supply = leaves.groupBy(*names).agg(F.sum("__mx_tokens").alias("tokens")).select(
        *names, F.col("tokens").cast("decimal(38,0)").alias("tokens"))
    caps = {}
    for depth in (1, 2, 3):
        caps[depth] = (supply.groupBy(*names[:depth]).agg(F.sum("tokens").alias("tokens"))
                       .select(*names[:depth], "tokens", (F.col("tokens") * mix.epochs).cast("decimal(38,0)").alias("cap"),
                               mix.weight(LEVELS[depth - 1]).alias("w")))
    root = supply.agg(F.expr(f"CAST(coalesce(sum(tokens), 0) * {mix.budget_permille} div 1000 "
                             "AS decimal(38,0))").alias("quota"))
    nodes = root.crossJoin(caps[1])  # one row with the domains
    down = fill(nodes, [], names[0])
    for depth in (2, 3):
        parent = down.select(*names[:depth - 1], F.col("share").alias("quota"))
        down = fill(parent.join(caps[depth], names[:depth - 1]), names[:depth - 1], names[depth - 1])
    return down.select(*names, F.col("tokens").cast("long"), F.col("share").cast("long").alias("quota"))


def plan(docs: DataFrame, mix: Mix = PRODUCTION, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``docs`` with their leaf's numbers, and the cut of each leaf: epochs taken
    whole, the rest's bucket and the tokens left for it."""
    leaves = _leaves(docs, mix, id_col, text_col)
    names = [f"__mx_{level}" for level in LEVELS]
    narrow = materialise(leaves.select(*names, "__mx_tokens", "__mx_id"), "mix-leaves")
    quota = materialise(
        budgets(narrow, mix).select(
            *names, F.col("tokens").alias("__mx_supply"), F.col("quota").alias("__mx_quota"),
            F.expr("IF(tokens > 0, quota div tokens, 0)").cast("int").alias("__mx_epochs"),
            F.expr("IF(tokens > 0, quota % tokens, 0)").cast("long").alias("__mx_rest")), "mix-quota")
    # the partial epoch's order differs by leaf: its number is the epochs taken whole
    placed = narrow.join(quota, names).select(
        *names, "__mx_tokens", "__mx_rest",
        F.substring(order_key(mix, F.col("__mx_epochs")), 1, DIGITS).alias("bucket"))
    sums = placed.groupBy(*names, "__mx_rest", "bucket").agg(F.sum("__mx_tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*names).orderBy("bucket"))
    cut = (sums.withColumn("upto", upto).where((F.col("upto") >= F.col("__mx_rest")) & (F.col("__mx_rest") > 0))
           .groupBy(*names).agg(F.min(F.struct("bucket", (F.col("__mx_rest") - F.col("upto") + F.col("n")).alias("room"))).alias("cut")))
    cuts = quota.join(cut, names, "left").select(
        *quota.columns, F.col("cut.bucket").alias("__mx_cut"), F.col("cut.room").alias("__mx_room"))
    return leaves, materialise(cuts, "mix-cuts")


def _taken(docs: DataFrame, mix: Mix, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with __mx_ columns: epochs, and whether the partial epoch takes the
    row.  A document that reaches over the cut belongs to the prefix if it begins
    before it."""
    leaves, cuts = plan(docs, mix, id_col, text_col)
    names = [f"__mx_{level}" for level in LEVELS]
    # one row per leaf: the planner broadcasts it or splits the hot leaf
    df = leaves.join(cuts, names).withColumn("__mx_key", order_key(mix, F.col("__mx_epochs")))
    bucket = F.substring("__mx_key", 1, DIGITS)
    edge = df.where(bucket == F.col("__mx_cut"))
    rank = Window.partitionBy(*names).orderBy("__mx_key", F.xxhash64(F.col(f"`{text_col}`")))
    edge = edge.withColumn("__mx_before", F.sum("__mx_tokens").over(
        rank.rowsBetween(Window.unboundedPreceding, -1)))
    edge = edge.withColumn("__mx_part", F.coalesce("__mx_before", F.lit(0)) < F.col("__mx_room")).drop("__mx_before")
    # rows without a cut (nothing left over) and rows of other buckets are decided alone
    rest = df.where(F.col("__mx_cut").isNull() | (bucket != F.col("__mx_cut"))).withColumn(
        "__mx_part", F.coalesce(bucket < F.col("__mx_cut"), F.lit(False)))
    return rest.unionByName(edge)


def mix(docs: DataFrame, mix: Mix = PRODUCTION, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, leaf_tokens, leaf_quota, copies)
    per row of ``docs``: how often the row goes into the mixture.

    Null languages and sources are the empty name, null texts have no tokens and
    are taken with the whole epochs or if they fall before the cut; rows without
    an id share one place in the order.  Repeated rows tie and are taken one by
    one up to the cut.  An empty table gives an empty result.
    """
    return _taken(docs, mix, id_col, text_col).select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col("__mx_domain").alias("domain"), F.col("__mx_lang").alias("lang"),
        F.col("__mx_source").alias("source"), F.col("__mx_tokens").alias("n_tokens"),
        F.col("__mx_supply").alias("leaf_tokens"), F.col("__mx_quota").alias("leaf_quota"),
        (F.col("__mx_epochs") + F.col("__mx_part").cast("int")).cast("long").alias("copies"))


def select(docs: DataFrame, mix: Mix = PRODUCTION, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the mixture takes, once for each time; a ``domain``
    column, where there is one, heads the tree."""
    taken = _taken(docs, mix, id_col, text_col)
    copies = F.col("__mx_epochs") + F.col("__mx_part").cast("int")
    return (taken.withColumn("__mx_copy", F.explode(F.expr(
        "IF(__mx_epochs + CAST(__mx_part AS INT) > 0, sequence(1, __mx_epochs + CAST(__mx_part AS INT)), array())")))
        .where(copies > 0).select(*[F.col(f"`{c}`") for c in docs.columns]))


def oracle_sql(mix: Mix = PRODUCTION) -> str:
    """mix() as DuckDB SQL over ``documents`` with distinct ids."""
    def weight(level):
        cases = " ".join(f"WHEN '{n}' THEN {w}" for n, w in mix.weights.get(level, {}).items())
        return f"(CASE {level} {cases} ELSE {mix.default} END)::HUGEINT" if cases else f"{mix.default}::HUGEINT"

    def level(name, parent, child, keys):
        by = f"PARTITION BY {', '.join(keys)}" if keys else ""
        columns = ", ".join([*keys, child])
        join = f"JOIN {parent} p USING ({', '.join(keys)})" if keys else f"CROSS JOIN {parent} p"
        return f"""
{name}_n AS (SELECT {columns}, c.tokens, c.cap, c.w, p.quota FROM
  (SELECT {columns}, sum(tokens)::HUGEINT AS tokens, (sum(tokens) * {mix.epochs})::HUGEINT AS cap, {weight(child)} AS w
   FROM supply GROUP BY {columns}) c {join}),
{name}_f AS (SELECT *, cap * sum(w) OVER ({by} ORDER BY cap::DOUBLE / w::DOUBLE, {child}
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
  <= (quota - coalesce(sum(cap) OVER ({by} ORDER BY cap::DOUBLE / w::DOUBLE, {child}
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w AS is_full FROM {name}_n),
{name}_r AS (SELECT *, (quota - coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({by}), 0))::HUGEINT AS rest,
  (sum(CASE WHEN NOT is_full THEN w END) OVER ({by}))::HUGEINT AS w_rest,
  (sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ({by} ORDER BY cap::DOUBLE / w::DOUBLE, {child}))::HUGEINT AS w_upto
  FROM {name}_f),
{name} AS (SELECT {columns}, tokens, CASE WHEN is_full THEN cap
  ELSE rest * w_upto // w_rest - rest * (w_upto - w) // w_rest END AS quota FROM {name}_r)"""

    key = f"md5('{mix.seed}:' || epochs || ':' || coalesce(doc_id::VARCHAR, ''))"
    return f"""
WITH base AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  len(regexp_extract_all(coalesce(text, ''), '{WORD_CLASS}'))::BIGINT AS n_tokens,
  regexp_extract(coalesce(source, ''), '^src([0-9]{{1,6}})$', 1) AS num FROM documents),
leaf AS (SELECT *, CASE WHEN num = '' THEN 'forum' WHEN num::INT < 5 THEN 'web' WHEN num::INT < 10 THEN 'books'
  ELSE 'forum' END AS domain FROM base),
supply AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens FROM leaf GROUP BY ALL),
root AS (SELECT (sum(tokens) * {mix.budget_permille} // 1000)::HUGEINT AS quota FROM supply),
{level("l1", "root", "domain", [])},
{level("l2", "l1", "lang", ["domain"])},
{level("l3", "l2", "source", ["domain", "lang"])},
cuts AS (SELECT *, CASE WHEN tokens > 0 THEN quota // tokens ELSE 0 END AS epochs,
  CASE WHEN tokens > 0 THEN quota % tokens ELSE 0 END AS rest FROM l3),
placed AS (SELECT leaf.*, cuts.tokens, cuts.quota, cuts.epochs, cuts.rest, {key} AS k
  FROM leaf JOIN cuts USING (domain, lang, source)),
ranked AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed)
SELECT doc_id, domain, lang, source, n_tokens, tokens::BIGINT AS leaf_tokens, quota::BIGINT AS leaf_quota,
  (epochs + CASE WHEN rest > 0 AND before < rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM ranked
"""
