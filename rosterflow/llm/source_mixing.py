"""Mixing a corpus to target weights by iterative proportional fitting.

The tokens of every (source, language, topic) cell are raked until the
marginals of all three meet their targets; the ratio of fitted to present
tokens is the cell's factor, and documents are drawn with probabilities
proportional to it.  The factors are scaled so that the expected number of
tokens is the wanted share of the corpus; cells that reach probability one are
taken whole and the rest is scaled further.

Only cell sums are iterated on; documents are read once for the sums and once
for the draw.  Everything is a DataFrame expression: no Python runs on the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterflow.llm.common import WORD_CLASS, register, table
from rosterflow.session import scratch, settle

DIMENSIONS = ("source", "lang", "topic")
POWER = 0.5
RATE = 0.7
SWEEPS = 20
SEED = "mix"
_SETTLE_EVERY = 5


def n_words(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD_CLASS + "+")).cast("long")


def form_topic(text: str, words: str) -> Column:
    """The form of a text, standing in for a topic where the corpus has no such column."""
    t, n = F.coalesce(F.col(text), F.lit("")), F.col(words)

    def count(characters: str) -> Column:
        return F.regexp_count(t, F.lit(f"[{characters}]"))

    return (
        F.when(n == 0, "empty").when(10 * count("#*$%&|<>") >= n, "markup").when(10 * count("!") >= n, "exclaim")
        .when(20 * (count("\n") + 1) >= n, "list").when(n < 200, "note").otherwise("article")
    )


def _described(docs: DataFrame, text: str, topic: str | None) -> DataFrame:
    df = docs.withColumn("_mix_words", n_words(text))
    df = df.withColumn("_mix_topic", F.coalesce(F.col(topic), F.lit("")) if topic else form_topic(text, "_mix_words"))
    return df.withColumns({f"_mix_{d}": F.coalesce(F.col(d), F.lit("")) for d in DIMENSIONS[:2]})


def tempered_targets(cells: DataFrame, dimension: str, power: float = POWER) -> DataFrame:
    """``_mix_<dimension>, share``: each value's share of the tokens to the given power, normalised."""
    sums = cells.groupBy(f"_mix_{dimension}").agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("_p"))
    return sums.select(f"_mix_{dimension}", (F.col("_p") / F.sum("_p").over(Window.partitionBy(F.lit(0)))).alias("share"))


def fit(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` with ``fitted`` tokens raked to the targets; a value without a target keeps its present share."""
    total = F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    df = cells.withColumn("_total", total).withColumn("fitted", F.col("tokens").cast("double"))
    for d in DIMENSIONS:
        share = targets[d].withColumnRenamed("share", f"_share_{d}")
        own = F.sum("tokens").over(Window.partitionBy(f"_mix_{d}")) / F.col("_total")
        df = df.join(share, f"_mix_{d}", "left").withColumn(f"_share_{d}", F.coalesce(f"_share_{d}", own))
    df = settle(df, "cells")
    for sweep in range(1, sweeps + 1):
        for d in DIMENSIONS:
            present = F.sum("fitted").over(Window.partitionBy(f"_mix_{d}"))
            df = df.withColumn("fitted", F.col("fitted") * F.col(f"_share_{d}") * F.col("_total") / present)
        if sweep % _SETTLE_EVERY == 0 or sweep == sweeps:
            df = settle(df, "sweep")
    return df


def probabilities(fitted: DataFrame, rate: float = RATE) -> DataFrame:
    """Each cell's probability: proportional to its factor, at most one, expecting ``rate`` of all tokens."""
    df = fitted.withColumn("_factor", F.col("fitted") / F.col("tokens"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("_factor"), *(f"_mix_{d}" for d in DIMENSIONS))
    before = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("fitted").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    df = df.withColumn("_scale", (F.lit(rate) * F.col("_total") - before) / rest)
    # The first cell from which on no probability exceeds one gives the scale of all; those before it are taken whole.
    fits = F.when(F.col("_scale") * F.col("_factor") <= 1, F.struct((-F.col("_factor")).alias("_f"), F.col("_scale")))
    chosen = F.min(fits).over(Window.partitionBy(F.lit(0)))["_scale"]
    return df.select(
        *(f"_mix_{d}" for d in DIMENSIONS), "tokens", "fitted",
        F.coalesce(F.least(F.lit(1.0), F.greatest(F.lit(0.0), chosen) * F.col("_factor")), F.lit(1.0)).alias("probability"),
    )


def uniform(key: str, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def _drawn(
    docs: DataFrame, key: str, text: str, topic: str | None, targets: dict[str, DataFrame] | None, power: float, rate: float, sweeps: int, seed: str
) -> DataFrame:
    """``docs`` with ``_mix_topic``, ``_mix_words``, ``_mix_chance`` and ``_mix_kept``."""
    df = _described(docs, text, topic)
    with scratch():
        keys = [f"_mix_{d}" for d in DIMENSIONS]
        cells = settle(df.where("_mix_words > 0").groupBy(*keys).agg(F.sum("_mix_words").alias("tokens")), "token-sums")
        wanted = {d: (targets or {}).get(d) for d in DIMENSIONS}
        wanted = {d: tempered_targets(cells, d, power) if t is None else t for d, t in wanted.items()}
        chances = probabilities(fit(cells, wanted, sweeps), rate).select(*keys, F.col("probability").alias("_mix_p"))
        chances = settle(chances, "probabilities", outlives=True)
    chance = F.when(F.col("_mix_words") > 0, F.coalesce("_mix_p", F.lit(0.0))).otherwise(F.lit(0.0))
    return df.join(chances, keys, "left").withColumn("_mix_chance", chance).withColumn("_mix_kept", uniform(key, seed) < F.col("_mix_chance"))


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", topic: str | None = None, targets: dict[str, DataFrame] | None = None,
    power: float = POWER, rate: float = RATE, sweeps: int = SWEEPS, seed: str = SEED,
) -> DataFrame:
    """``key, topic, n_words, probability, kept`` of every row.

    ``targets`` gives the wanted shares per dimension (a DataFrame of
    ``_mix_<dimension>, share``); by default they are the present ones, tempered.
    A null source or language counts as an empty one.  Texts without words hold no
    tokens: they have probability 0.  The draw depends on the key alone, so
    repeated rows share their fate; a null key is drawn like an empty text of it.
    """
    drawn = _drawn(docs, key, text, topic, targets, power, rate, sweeps, seed)
    return drawn.select(
        key, F.col("_mix_topic").alias("topic"), F.col("_mix_words").alias("n_words"), F.col("_mix_chance").alias("probability"),
        F.col("_mix_kept").alias("kept"),
    )


def sample(
    docs: DataFrame, key: str = "doc_id", text: str = "text", topic: str | None = None, targets: dict[str, DataFrame] | None = None,
    power: float = POWER, rate: float = RATE, sweeps: int = SWEEPS, seed: str = SEED,
) -> DataFrame:
    """The rows of ``docs`` that ``mix`` draws, with their own columns."""
    return _drawn(docs, key, text, topic, targets, power, rate, sweeps, seed).where("_mix_kept").select(*docs.columns)


def _oracle() -> str:
    count = "(length(t) - length(regexp_replace(t, '{}', '', 'g')))"
    steps = []
    last = "s0"
    for sweep in range(SWEEPS):
        for d in DIMENSIONS:
            name = f"s{sweep}_{d}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT * REPLACE (fitted * share_{d} * total / sum(fitted) OVER (PARTITION BY {d}) AS fitted) FROM {last})"
            )
            last = name
    shares = ", ".join(
        f"t_{d} AS MATERIALIZED (SELECT {d}, p / sum(p) OVER () AS share_{d} FROM (SELECT {d}, pow(sum(tokens)::DOUBLE, {POWER}) AS p FROM cells GROUP BY {d}))"
        for d in DIMENSIONS
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, len(regexp_extract_all(t, '{WORD_CLASS}+'))::BIGINT AS n_words FROM d),
x AS MATERIALIZED (SELECT doc_id, source, lang, n_words, CASE WHEN n_words = 0 THEN 'empty'
        WHEN 10 * {count.format("[#*$%&|<>]")} >= n_words THEN 'markup' WHEN 10 * {count.format("!")} >= n_words THEN 'exclaim'
        WHEN 20 * ({count.format(chr(92) + "n")} + 1) >= n_words THEN 'list' WHEN n_words < 200 THEN 'note' ELSE 'article' END AS topic FROM w),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_words)::BIGINT AS tokens FROM x WHERE n_words > 0 GROUP BY ALL),
{shares},
s0 AS MATERIALIZED (SELECT c.*, (sum(tokens) OVER ())::BIGINT AS total, tokens::DOUBLE AS fitted, share_source, share_lang, share_topic
       FROM cells c JOIN t_source USING (source) JOIN t_lang USING (lang) JOIN t_topic USING (topic)),
{", ".join(steps)},
f AS (SELECT *, fitted / tokens AS factor FROM {last}),
o AS (SELECT *, ({RATE} * total - coalesce(sum(tokens) OVER (ORDER BY factor DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
       / sum(fitted) OVER (ORDER BY factor DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale FROM f),
sc AS (SELECT scale AS chosen FROM o WHERE scale * factor <= 1 ORDER BY factor DESC, scale LIMIT 1),
p AS (SELECT source, lang, topic, least(1.0, greatest(0.0, chosen) * factor) AS probability FROM o, sc)
SELECT doc_id, x.topic, n_words, round(coalesce(probability, 0), 6) AS probability,
       ('0x' || substr(md5('{SEED}:' || doc_id), 1, 13))::BIGINT / {float(1 << 52)} < coalesce(probability, 0) AS kept
FROM x LEFT JOIN p ON x.source = p.source AND x.lang = p.lang AND x.topic = p.topic AND n_words > 0"""


@register("op5_mixing", _oracle())
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its drawing probability under tempered source, language and topic weights, and whether it is drawn."""
    drawn = mix(table(spark, sf_dir, "documents"))
    return drawn.select("doc_id", "topic", "n_words", F.round("probability", 6).alias("probability"), "kept")
