"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed into cells (source, language, topic).  Raking scales the cells' token weights to the target share
of each source, then of each language, then of each topic, and again, until the marginals agree.  The ratio of a cell's raked
weight to its own mass, over the largest such ratio, is the probability with which its documents are drawn, so expected tokens follow
the targets and no document is needed twice.  Where a rare cell's ratio would so thin out the whole corpus below a budget of tokens,
the divisor is lowered until the budget is met: cells above 1 are kept whole, the others still follow the targets among themselves.
The draw is a hash of the document id: a task that runs again draws alike.

Cells are sums, so a hot source is one row per language and topic before anything is shuffled or joined.  DataFrame functions only.
"""

from __future__ import annotations

import warnings
from collections import deque
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import WORD, table
from strataflow.session import settle

DIMENSIONS = ("source", "lang", "topic")
# Target share of a value: its share of all tokens to this power, scaled to one.  Below 1 lifts the rare values.
FLATTEN = {"source": 0.7, "lang": 0.85, "topic": 1.0}
# Raking makes SWEEPS sweeps at least and goes on until every marginal is within TOLERANCE of its target, relative to the target.
SWEEPS, TOLERANCE = 6, 0.005
# Targets that the cells cannot meet together show by an error that falls by less than a hundredth in so many sweeps.
STALLED = 10
# At least this share of all tokens is drawn, however rare the rarest cell is.
BUDGET = 0.6
NONE = "(none)"


def tokens_of(text: Column) -> Column:
    """Words and one end mark, so that no document weighs nothing."""
    return (F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)) + 1).cast("long")


def topic_of(text: Column) -> Column:
    """A topic by the text's form, for tables without a topic column: table, marked, licence, long or prose; empty if null or blank."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    marks = F.length(whole) - F.length(F.translate(whole, "#*$%&", ""))
    return (
        F.when(~whole.rlike(WORD), F.lit("empty")).when(whole.contains(" | "), F.lit("table"))
        .when(marks * 50 >= F.length(whole), F.lit("marked")).when(whole.contains("icense"), F.lit("licence"))
        .when(F.length(whole) >= 8000, F.lit("long")).otherwise(F.lit("prose"))
    )


def uniform(key: Column, salt: str = "mix") -> Column:
    """A number in [0, 1) fixed by the key."""
    digest = F.md5(F.concat(F.lit(f"{salt}/"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16 ** 13)


def flattened(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(dimension, share): the target share of each value."""
    mass = cells.groupBy(dimension).agg(F.sum("mass").alias("mass"))
    lifted = settle(mass.select(dimension, F.pow(F.col("mass").cast("double"), F.lit(power)).alias("lifted")), f"mix-{dimension}")
    return lifted.select(dimension, (F.col("lifted") / lifted.agg(F.sum("lifted")).scalar()).alias("share"))


def misfit(now: DataFrame, dimensions: Iterable[str]) -> float:
    """The largest relative error of a value's weight against its target, which ``now`` holds as ``__`` and the dimension's name."""
    errors = [
        now.groupBy(name).agg(F.sum("weight").alias("weight"), F.max(f"__{name}").alias("share")).where("share > 0")
        .select(F.abs(F.col("weight") / F.col("share") - 1).alias("error")) for name in dimensions]
    return reduce(DataFrame.union, errors).agg(F.max("error")).first()[0] or 0.0


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], sweeps: int = SWEEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """Cells with ``weight``: the mass scaled to the target share of every dimension.

    ``targets`` holds (dimension, share) by dimension; a value without a target gets weight 0.  After ``sweeps`` sweeps
    raking goes on until every target is met within ``tolerance``.  Targets that the cells with mass cannot meet together
    give a warning with the error that is left; the dimension raked last then fits exactly.
    """
    now = cells.withColumn("weight", F.col("mass").cast("double"))
    for name, shares in targets.items():
        now = now.join(shares.select(F.col(name), F.col("share").alias(f"__{name}")), name, "left")
    now = settle(now.na.fill(0.0, [f"__{name}" for name in targets]), "mix-cells")
    errors, done = deque(maxlen=STALLED + 1), 0
    while True:
        for name in targets:
            margin = now.groupBy(name).agg(F.sum("weight").alias("__margin"))
            scaled = F.when(F.col("__margin") > 0, F.col("weight") * F.col(f"__{name}") / F.col("__margin")).otherwise(F.lit(0.0))
            now = settle(now.join(margin, name).withColumn("weight", scaled).drop("__margin"), "mix-cells")
        done += 1
        if done < sweeps:
            continue
        errors.append(misfit(now, targets))
        if errors[-1] <= tolerance:
            break
        if len(errors) > STALLED and errors[-1] > 0.99 * errors[0]:
            warnings.warn(f"mixing targets cannot be met: a marginal is off by {errors[-1]:.1%} after {done} sweeps", stacklevel=2)
            break
    return now.drop(*[f"__{name}" for name in targets])


def divisor(raked: DataFrame, budget: float = BUDGET) -> float:
    """What ratios of weight to mass are divided by: the largest, or what draws ``budget`` of all mass with probabilities limited to 1.

    The drawn mass is a concave, piecewise linear function of 1 / divisor, so Newton's steps from the largest ratio rise to
    the budget without passing it.  Only sums reach the driver.
    """
    ratio = F.col("weight") / F.col("mass")
    base = raked.agg(F.max(ratio)).first()[0]
    while base:
        whole = ratio >= base
        at = raked.agg(
            F.sum("mass").alias("all"), F.sum(F.when(whole, F.col("mass")).otherwise(0)).alias("whole"),
            F.sum(F.when(whole, 0.0).otherwise(F.col("weight"))).alias("rest")).first()
        wanted = budget * at["all"] - at["whole"]
        if not at["rest"] or at["rest"] / base >= wanted * (1 - 1e-9):
            break
        base = at["rest"] / wanted
    return base or 1.0


def described(docs: DataFrame, text: str = "text", topic: Column | None = None) -> DataFrame:
    """The rows with dimensions and tokens in columns of their own, so that columns of the input may have any names."""
    value = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic if topic is not None else topic_of(F.col(text))}
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        *[F.coalesce(value[d].cast("string"), F.lit(NONE)).alias(d) for d in DIMENSIONS], tokens_of(F.col(text)).alias("tokens"))


def calibrated(docs: DataFrame, power: Mapping[str, float] = FLATTEN, sweeps: int = SWEEPS, rate: float = 1.0,
               budget: float = BUDGET) -> DataFrame:
    """(row, source, lang, topic, tokens, probability).  Null dimensions are a value of their own, ``(none)``.

    The expected tokens are at least ``budget`` of all, times ``rate``.  An empty table gives an empty result; rows that repeat are weighed each.
    """
    marked = described(docs)
    cells = settle(marked.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("mass")), "mix-cells")
    raked = rake(cells, {d: flattened(cells, d, power[d]) for d in DIMENSIONS}, sweeps)
    ratio = F.col("weight") / F.col("mass")
    chances = raked.select(*DIMENSIONS, (F.lit(rate) * F.least(F.lit(1.0), ratio / divisor(raked, budget))).alias("probability"))
    return marked.join(chances, list(DIMENSIONS))


def sample(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The drawn documents, with the columns of ``docs``.  Rows that repeat a key are drawn together."""
    drawn = calibrated(docs, **options).where(uniform(F.col(f"row.{key}")) < F.col("probability"))
    return drawn.select("row.*")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its cell, tokens, calibrated probability and whether it is drawn."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    chance = F.col("probability")
    return calibrated(docs).select(
        F.col("row.doc_id").alias("doc_id"), *DIMENSIONS, "tokens", F.round(chance, 9).alias("probability"),
        (uniform(F.col("row.doc_id")) < chance).alias("kept"))


def op10_sql(sweeps: int = SWEEPS, most: int = 24, budget: float = BUDGET, tolerance: float = TOLERANCE) -> str:
    """The same fitting as chained relations: the first sweep after which every marginal fits, of ``most`` written out, and the budget in closed form.

    The divisor that draws the budget keeps the cells of the largest ratios whole; sums over the cells in the order of their ratios give, for every number
    of whole cells, the divisor that goes with it, and the right one lies between the ratios at that place.
    """
    steps, at, errors = [], "start_cells", []
    for n in range(most):
        for d in DIMENSIONS:
            steps.append(
                f"r{n}_{d} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.mass, "
                f"c.weight * t.share / sum(c.weight) OVER (PARTITION BY c.{d}) AS weight FROM {at} c JOIN t_{d} t ON t.v = c.{d})")
            at = f"r{n}_{d}"
        if n + 1 >= sweeps:
            parts = " UNION ALL ".join(
                f"SELECT max(abs(w / share - 1)) AS e FROM (SELECT {d} AS v, sum(weight) AS w FROM {at} GROUP BY 1) JOIN t_{d} USING (v)" for d in DIMENSIONS)
            errors.append(f"SELECT {n} AS n, (SELECT max(e) FROM ({parts})) AS e")
    fits = "\n  UNION ALL ".join(errors)
    found = "\n  UNION ALL ".join(f"SELECT *, {n} AS n FROM r{n}_{DIMENSIONS[-1]}" for n in range(sweeps - 1, most))
    shares = ",\n".join(
        f"t_{d} AS (SELECT v, lifted / sum(lifted) OVER () AS share FROM "
        f"(SELECT {d} AS v, pow(sum(mass)::DOUBLE, {FLATTEN[d]}) AS lifted FROM start_cells GROUP BY 1))" for d in DIMENSIONS)
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang, coalesce(text, '') AS text FROM documents
), marked AS MATERIALIZED (
  SELECT doc_id, source, lang, len(regexp_extract_all(text, '{WORD}'))::BIGINT + 1 AS tokens,
    CASE WHEN NOT regexp_matches(text, '{WORD}') THEN 'empty' WHEN contains(text, ' | ') THEN 'table'
         WHEN (length(text) - length(translate(text, '#*$%&', ''))) * 50 >= length(text) THEN 'marked'
         WHEN contains(text, 'icense') THEN 'licence' WHEN length(text) >= 8000 THEN 'long' ELSE 'prose' END AS topic
  FROM d
), start_cells AS MATERIALIZED (
  SELECT source, lang, topic, sum(tokens)::BIGINT AS mass, sum(tokens)::DOUBLE AS weight FROM marked GROUP BY ALL
),
{shares},
{", ".join(steps)},
fits AS MATERIALIZED ({fits}),
raked AS MATERIALIZED (SELECT * FROM ({found}) WHERE n = (SELECT coalesce(min(n) FILTER (WHERE e <= {tolerance}), max(n)) FROM fits)),
ratios AS (SELECT weight / mass AS ratio, sum(mass)::DOUBLE AS mass, sum(weight) AS weight FROM raked GROUP BY 1),
places AS (
  SELECT ratio, coalesce(lead(ratio) OVER (ORDER BY ratio DESC), 0) AS below, sum(mass) OVER (ORDER BY ratio DESC) AS whole,
    coalesce(sum(weight) OVER (ORDER BY ratio DESC ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS rest, {budget} * sum(mass) OVER () AS wanted
  FROM ratios
), divisors AS (
  SELECT CASE WHEN (SELECT sum(least(1.0, weight / mass / m) * mass) FROM raked, (SELECT max(ratio) AS m FROM ratios)) >= (SELECT max(wanted) FROM places)
              THEN (SELECT max(ratio) FROM ratios)
              ELSE (SELECT min(rest / (wanted - whole)) FROM places WHERE wanted > whole AND rest / (wanted - whole) <= ratio AND rest / (wanted - whole) > below) END AS base
),
chances AS (SELECT source, lang, topic, least(1.0, weight / mass / base) AS p FROM raked, divisors)
SELECT doc_id, source, lang, topic, tokens, round(p, 9) AS probability,
       ('0x' || substr(md5('mix/' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / pow(16, 13) < p AS kept
FROM marked JOIN chances USING (source, lang, topic)
"""
