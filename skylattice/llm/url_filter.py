"""URL filters: rules first, then logistic regression on hashed character n-grams.

A rule names a host and the beginning of a path; it fits the host and all its
subdomains, and the longest rule that fits decides. For all other URLs a logistic
regression does, whose features are the distinct 3- and 4-grams of characters of
the host and of the path, each with marks for its two ends, hashed into
``BUCKETS``. It is trained from a small table of labelled URLs by ``STEPS`` steps
of full gradients with a step size of its own for each weight: every step is one
aggregation over the table; the driver keeps the ``BUCKETS`` weights.

Everything is DataFrame functions: judging is one projection without a shuffle.
Rules are a bounded list, written into the plan.

A URL that is null or has no '://' has an empty host and path, which no rule
fits, and is judged by the features of empty strings. Letters of a host are
lower-cased from A to Z, paths are taken as they are. Without labelled URLs of
both kinds every URL that no rule decides is allowed. Rows that repeat a URL are
judged alike. Other columns are not read by the query.
"""

from __future__ import annotations

import json
import math
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylattice.llm.workspace import Workspace

BUCKETS = 4096
GRAMS = (3, 4)
STEPS = 20
RATE = 0.5
LABELLED = 2000  # of each verdict

#: (host, path, verdict); fixed values.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def parts(url: str = "url") -> tuple[Column, Column]:
    """Host and path of a URL."""
    at = F.coalesce(F.instr(F.col(url), "://"), F.lit(0))
    rest = F.when(at > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), ascii_uppercase, ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(rules: list[tuple[str, str, str]], host: str = "host", path: str = "path") -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]), r)):
        fits = ((F.col(host) == name) | F.col(host).endswith("." + name)) & F.col(path).startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def features(host: str = "host", path: str = "path", buckets: int = BUCKETS) -> Column:
    """Distinct buckets of the n-grams of both parts."""
    grams = []
    for tag, name in (("h", host), ("p", path)):
        chars = f"concat(array('^'), filter(split({name}, ''), c -> c <> ''), array('$'))"
        for n in GRAMS:
            gram = ", ".join(f"c[i + {j}]" for j in range(n))
            grams.append(
                f"flatten(transform(array({chars}), c -> if(size(c) < {n}, array(), "
                f"transform(sequence(0, size(c) - {n}), i -> cast(pmod(xxhash64(concat('{tag}', {gram})), {buckets}) as int)))))"
            )
    return F.expr(f"array_distinct(concat({', '.join(grams)}))")


def _margin(weights: list[float], bias: float) -> Column:
    known = json.dumps(weights)
    return F.expr(f"aggregate(features, {bias!r}D, (s, i) -> s + from_json('{known}', 'array<double>')[i])")


def train(labelled: DataFrame, steps: int = STEPS, rate: float = RATE, buckets: int = BUCKETS) -> tuple[list[float], float] | None:
    """(weights, bias) from rows (url, blocked: 0 or 1); None unless both kinds are there."""
    host, path = parts()
    rows = labelled.where("url is not null and blocked in (0, 1)").select(host.alias("host"), path.alias("path"), F.col("blocked").cast("double"))
    work = Workspace(labelled.sparkSession)
    rows = work.stage(rows.select(features(buckets=buckets).alias("features"), "blocked").coalesce(1))
    n, blocked = rows.agg(F.count("*"), F.coalesce(F.sum("blocked"), F.lit(0.0))).first()
    if not 0 < blocked < n:
        return None
    weights, bias = [0.0] * buckets, 0.0
    size = [1e-6] * (buckets + 1)
    for _ in range(steps):
        chance = 1 / (1 + F.exp(-_margin(weights, bias)))
        slope = rows.select(F.explode(F.concat("features", F.array(F.lit(buckets)))).alias("bucket"), (F.col("blocked") - chance).alias("d"))
        for bucket, d in slope.groupBy("bucket").agg(F.sum("d").alias("d")).collect():
            d /= n
            size[bucket] += d * d
            step = rate * d / math.sqrt(size[bucket])
            if bucket == buckets:
                bias += step
            else:
                weights[bucket] += step
    work.drop(rows)
    return weights, bias


def by_rule(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, limit: int = LABELLED) -> DataFrame:
    """A small labelled table (url, blocked): at most ``limit`` URLs of each verdict of a rule, those with the smallest hashes."""
    host, path = parts()
    found = pages.where("url is not null").select("url", host.alias("host"), path.alias("path"))
    found = found.select("url", rule_for(rules)["verdict"].alias("verdict")).where("verdict is not null").distinct()
    found = found.withColumn("blocked", (F.col("verdict") == "block").cast("int")).drop("verdict")
    drawn = [found.where(F.col("blocked") == kind).orderBy(F.xxhash64("url"), "url").limit(limit) for kind in (0, 1)]
    return drawn[0].union(drawn[1]).select("url", "blocked")


def judge(pages: DataFrame, model: tuple[list[float], float] | None, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row of ``pages`` (page_id, url); score is the chance to be blocked."""
    host, path = parts()
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("fit", rule_for(rules))
    score = F.lit(0.0) if model is None else 1 / (1 + F.exp(-_margin(*model)))
    rows = rows.withColumn("features", features()).withColumn("score", score)
    learnt = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", learnt).alias("verdict"), "score")
