"""Mixing sources to target weights by hierarchical budgeting.

A corpus is a tree of domains, languages and sources. The token budget goes from
the root down: each node's budget is dealt to its children by their weights, none
more than its subtree holds in ``epochs`` passes; what a child cannot take goes to
its siblings first, as a node's share is reduced only when its whole subtree is
short, and then to its parent's siblings. The level at which all open children
stand is found in closed form from running sums over the children.

A leaf's tokens are read in seeded epochs, each a new order of its documents; the
leaf takes the longest prefix of whole documents that its budget holds. The end
of the prefix is found without sorting a leaf: token sums by slice of the order
give the slice in which the budget ends, and only that one is sorted. A leaf with
a third of all rows is spread over 4,096 slices, which are summed before they
are shuffled.

Tokens are runs of other than white space. A null or empty text has none and is
taken with the prefix that it lies in. Null sources and languages are leaves of
their own ('unknown'), as are unlisted ones at the default weight; weights that
are zero take nothing. Documents with the same id and seed stand at the same
place and are taken together or not at all. Rows without an id are numbered as they
are read, and text and number give each a place of its own: how many are taken does
not depend on the numbers, which of them does. Other columns are passed through, but
for own ones with names of those that are added, which are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylattice.llm.workspace import Workspace

SLICE_DIGITS = 3
LEVELS = ("domain", "lang", "source")
ADDED = ("mix_domain", "mix_lang", "mix_source", "mix_epoch", "mix_tokens", "mix_share")

#: Production weights; a name that is not listed has weight 1.
WEIGHTS: dict[str, Mapping[str, float]] = {
    "domain": {"web": 5.0, "reference": 3.0, "community": 2.0, "other": 1.0},
    "lang": {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0, "unknown": 0.5},
    "source": {},
}
BUDGET_SHARE = 0.6
EPOCHS = 2
SEED = 17


def domain_of(source: Column) -> Column:
    """Domain of a source name by its number: 0 to 9 web, 10 to 14 reference, 15 and up community."""
    number = F.regexp_extract(source, r"([0-9]{1,9})$", 1).try_cast("int")
    return F.when(number < 10, "web").when(number < 15, "reference").when(number.isNotNull(), "community").otherwise("other")


def weight_of(level: str, weights: Mapping[str, Mapping[str, float]]) -> Column:
    listed = weights.get(level, {})
    out = F.lit(1.0)
    if listed:
        pairs = F.create_map(*(F.lit(v) for item in listed.items() for v in (item[0], float(item[1]))))
        out = F.coalesce(F.try_element_at(pairs, F.col(level)), out)
    return out


def named(documents: DataFrame) -> DataFrame:
    """``documents`` with the names of the tree's levels."""
    source = F.coalesce("source", F.lit("unknown"))
    return documents.select(
        *(c for c in documents.columns if c not in LEVELS), domain_of(source).alias("domain"),
        F.coalesce("lang", F.lit("unknown")).alias("lang"), source.alias("source"),
    )


def tokens_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def place_of(epoch: Column, seed: int) -> Column:
    """Place of a document in the order of an epoch, 32 hexadecimal digits."""
    return F.md5(F.concat_ws("/", F.lit(str(seed)), epoch.cast("string"), "known"))


def known_rows(documents: DataFrame, work: Workspace) -> DataFrame:
    """(row, lang, source, text, known): what tells a document apart, its id or else its text and a stored number."""
    rows = documents.select(F.struct(*documents.columns).alias("row"), "doc_id", "lang", "source", "text")
    lost = rows.where("doc_id is null").withColumn("number", F.monotonically_increasing_id())
    lost = work.stage(lost.drop("doc_id")).withColumn("known", F.concat_ws("/", F.lit(""), F.md5("text"), F.col("number").cast("string")))
    rows = rows.where("doc_id is not null").withColumn("known", F.col("doc_id").cast("string"))
    return rows.drop("doc_id").unionByName(lost.drop("number"))


def deal(children: DataFrame, parent: list[str]) -> DataFrame:
    """``children`` (parent columns, capacity, weight, budget of the parent) with each child's ``share``.

    Child i would fill at the level capacity / weight. In that order, the level at
    which the budget is used up is that of the first child which does not fill.
    """
    names = [c for c in LEVELS if c in children.columns]
    children = children.withColumn("fill", F.expr("if(weight > 0, capacity / weight, cast('Infinity' as double))"))
    ahead = Window.partitionBy(*parent).orderBy("fill", *names).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy(*parent).orderBy(F.desc("fill"), *map(F.desc, names)).rowsBetween(Window.unboundedPreceding, 0)
    used = F.coalesce(F.sum(F.expr("if(weight > 0, capacity, 0D)")).over(ahead), F.lit(0.0))
    children = children.withColumn("used", used).withColumn("open", F.sum("weight").over(behind))
    children = children.withColumn("level", F.expr("if(open > 0, (budget - used) / open, null)"))
    level = F.max(F.when(F.col("level") <= F.col("fill"), F.col("level"))).over(Window.partitionBy(*parent))
    share = F.when(F.col("weight") > 0, F.least("capacity", F.coalesce(level * F.col("weight"), F.col("capacity")))).otherwise(0.0)
    return children.withColumn("share", share).drop("fill", "used", "open", "level")


def budgets(leaves: DataFrame, total_share: float = BUDGET_SHARE, weights: Mapping[str, Mapping[str, float]] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(domain, lang, source, tokens, share): the budget of every leaf of ``leaves`` (domain, lang, source, tokens).

    Each level is stored: planned as one, the levels are a query whose plan, told anew
    after each of its stages, takes much of the driver's memory.
    """
    work = Workspace(leaves.sparkSession)
    nodes = leaves.withColumn("capacity", F.col("tokens").cast("double") * epochs)
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    above = None
    for depth, level in enumerate(LEVELS):
        parent, names = list(LEVELS[:depth]), list(LEVELS[: depth + 1])
        children = nodes.groupBy(*names).agg(F.sum("capacity").alias("capacity")).withColumn("weight", weight_of(level, weights))
        children = children.withColumn("budget", F.lit(float(total) * total_share)) if above is None else children.join(above, parent)
        above = work.stage(deal(children, parent).select(*names, F.col("share").alias("budget")))
    return leaves.join(above.withColumnRenamed("budget", "share"), list(LEVELS))


def select_prefixes(documents: DataFrame, total_share: float = BUDGET_SHARE, weights: Mapping[str, Mapping[str, float]] = WEIGHTS,
                    epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """The rows of ``documents`` that are taken, once per epoch.

    The whole budget is ``total_share`` of all tokens. Added columns: mix_domain,
    mix_lang, mix_source, mix_epoch (from 0), mix_tokens, mix_share (the leaf's
    budget in tokens).
    """
    leaf = list(LEVELS)
    work = Workspace(documents.sparkSession)
    rows = known_rows(documents, work)
    slim = work.stage(named(rows).select("known", *leaf, tokens_of().alias("tokens")))
    held = work.stage(slim.groupBy(*leaf).agg(F.sum("tokens").alias("tokens")))

    # A leaf's budget covers `passed` whole epochs and ends `rest` tokens into the next one.
    goal = budgets(held, total_share, weights, epochs)
    goal = goal.withColumn("passed", F.expr(f"if(tokens > 0, cast(least(floor(share / tokens), {epochs}) as int), 0)"))
    goal = work.stage(goal.withColumn("rest", F.expr(f"if(passed >= {epochs}, 0D, share - passed * tokens)")))

    placed = slim.join(goal.where("rest > 0").select(*leaf, "passed", "rest"), leaf).withColumn("place", place_of(F.col("passed"), seed))
    placed = placed.withColumn("slice", F.substring("place", 1, SLICE_DIGITS))
    sums = placed.groupBy(*leaf, "rest", "slice").agg(F.sum("tokens").alias("sum"))
    sums = sums.withColumn("reach", F.sum("sum").over(Window.partitionBy(*leaf).orderBy("slice")))
    last = sums.where("reach > rest").groupBy(*leaf).agg(F.min(F.struct("slice", (F.col("reach") - F.col("sum")).alias("before"))).alias("last"))
    inside = placed.join(last.select(*leaf, "last.*"), [*leaf, "slice"]).groupBy(*leaf, "rest", "before", "place").agg(F.sum("tokens").alias("sum"))
    reach = F.col("before") + F.sum("sum").over(Window.partitionBy(*leaf).orderBy("place"))
    stop = inside.withColumn("reach", reach).where("reach > rest").groupBy(*leaf).agg(F.min("place").alias("stop"))
    ends = work.stage(goal.join(stop, leaf, "left").select(*leaf, "passed", "rest", "share", "stop"))
    work.drop(slim, held, goal)

    taken = named(rows).join(ends, leaf)
    begun = (F.col("rest") > 0) & (F.col("stop").isNull() | (place_of(F.col("passed"), seed) < F.col("stop")))
    taken = taken.withColumn("mix_count", F.col("passed") + F.when(begun, 1).otherwise(0)).where("mix_count > 0")
    taken = taken.select("*", F.explode(F.expr("sequence(0, mix_count - 1)")).alias("mix_epoch"))
    return taken.select(
        *(F.col("row")[c].alias(c) for c in documents.columns if c not in ADDED), *(F.col(c).alias(f"mix_{c}") for c in leaf), "mix_epoch", tokens_of().alias("mix_tokens"),
        F.round("share", 3).alias("mix_share"),
    )


def plain_sql(total_share: float = BUDGET_SHARE, weights: Mapping[str, Mapping[str, float]] = WEIGHTS, epochs: int = EPOCHS, seed: int = SEED) -> str:
    """The same selection in SQL for DuckDB, for tables where every row has an id: every leaf sorted whole, levels of the tree one after the other."""

    def weight(level: str) -> str:
        cases = " ".join(f"when '{name}' then {value}" for name, value in weights.get(level, {}).items())
        return f"cast(case {level} {cases} else 1 end as double)" if cases else "1.0::double"

    parts, above = [], None
    for depth, level in enumerate(LEVELS):
        parent, names = ", ".join(LEVELS[:depth]), ", ".join(LEVELS[: depth + 1])
        by = f"partition by {parent}" if parent else ""
        source = f"join {above}_b using ({parent})" if above else "cross join total"
        parts.append(f"""
        {level}_c as (select {names}, sum(cap) cap, {weight(level)} w from leaf group by {names}),
        {level}_l as (select {names}, cap, w, budget, case when w > 0 then cap / w else 'inf'::double end fill from {level}_c {source}),
        {level}_o as (select *, coalesce(sum(case when w > 0 then cap else 0 end) over ({by} order by fill, {names} rows between unbounded preceding and 1 preceding), 0) used,
            sum(w) over ({by} order by fill, {names} rows between current row and unbounded following) open from {level}_l),
        {level}_v as (select *, max(case when open > 0 and (budget - used) / open <= fill then (budget - used) / open end) over ({by}) lvl from {level}_o),
        {level}_b as (select {names}, case when w > 0 then least(cap, coalesce(lvl * w, cap)) else 0 end budget from {level}_v)""")
        above = level
    number = "try_cast(regexp_extract(coalesce(source, 'unknown'), '([0-9]{1,9})$', 1) as integer)"
    return f"""
    with docs as (
        select doc_id, coalesce(lang, 'unknown') lang, coalesce(source, 'unknown') source,
            case when {number} < 10 then 'web' when {number} < 15 then 'reference' when {number} is not null then 'community' else 'other' end domain,
            coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint tokens
        from documents),
    leaf as (select domain, lang, source, sum(tokens)::bigint tokens, sum(tokens)::double * {epochs} cap from docs group by all),
    total as (select coalesce(sum(tokens), 0)::double * {total_share} budget from leaf),
    {",".join(parts)},
    runs as (
        select d.*, b.budget share, cast(e as integer) epoch, l.tokens held,
            md5('{seed}/' || e || '/' || coalesce(doc_id::varchar, '')) place
        from docs d join leaf l using (domain, lang, source) join source_b b using (domain, lang, source), range({epochs}) r(e)),
    summed as (select *, epoch * held + sum(tokens) over (partition by domain, lang, source, epoch order by place) reach from runs)
    select doc_id, domain mix_domain, lang mix_lang, source mix_source, epoch mix_epoch, tokens mix_tokens, round(share, 3) mix_share
    from summed where reach <= share and share > 0 and held > 0"""
