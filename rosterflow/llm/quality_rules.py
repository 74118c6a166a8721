"""Quality rules whose cutoffs are certified on labelled documents.

Every rule is a measure in thousandths, higher is worse, and rejects documents
above a cutoff.  The cutoffs of all rules lie on one path: at level 0 each is the
rule's floor, at level ``TOP`` it is ``TOP``, and in between all have gone the same
share of their way.  What a level rejects, by any rule, a stricter one rejects as
well.  Per stratum (language) the strictest level is chosen whose false rejection
of good documents is certified by an exact binomial test: with ``n`` good labelled
documents, a level that rejects ``k`` of them is accepted if
``P(Bin(n, alpha) <= k) <= delta / strata``.  As levels are nested, they are tested
as a fixed sequence from lenient to strict, which costs no confidence, and as a
level stands for all rules together, ``alpha`` is not divided; only over strata the
error is (Bonferroni).  So with confidence ``1 - delta`` no stratum loses more than
``alpha`` of its good documents to the rules.  With four strata 144 good labels
suffice.  A stratum with fewer than it takes certifies nothing and keeps
everything the base rule keeps.  Documents of one level share its verdict.

Everything is a DataFrame expression: no Python runs on the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterflow.llm.common import SPACE_CLASS, WORD_CLASS, fold_held_out, register, table
from rosterflow.session import scratch, settle

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5
TOP = 20_000

ALPHA = 0.03
DELTA = 0.05
# A rule is never stricter than this, in thousandths, whatever the labels allow.
FLOORS = {"symbols": 100, "repeats": 150, "lines": 300, "capitals": 300, "long_words": 6500, "short_words": 16000}
CALIBRATION_FOLDS = 5


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """The counts of every whole text and the measures of the rules, one row per row of ``docs``.

    Null texts have no words.  A null stratum is one of its own.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(F.col(key), F.col(stratum).alias("_stratum"), t.alias("_t"))
    bare = F.trim(F.col("_t"), F.lit(SPACES))
    df = df.select(
        key, "_stratum", F.length(F.translate("_t", SPACES, "")).cast("long").alias("word_chars"),
        _without(F.col("_t"), SYMBOLS).cast("long").alias("n_symbols"),
        _without(F.col("_t"), CAPITALS).cast("long").alias("_capitals"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD_CLASS)).alias("_lines"),
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_CLASS + "+")).alias("_words"),
    )
    df = df.select(
        key, "_stratum", "word_chars", "n_symbols", "_capitals", F.size("_words").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        # Sizes first: a lambda over words that are used once would be pasted into the next one.
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    at = [F.lit(i) for i in range(WINDOW)]
    windows = F.transform(
        F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")), lambda i: F.xxhash64(*(F.get("_hashes", i + j) for j in at))
    )
    df = df.withColumn("_w", F.when(F.col("n_words") >= WINDOW, windows)).drop("_hashes")
    df = df.withColumn("_repeats", F.size(F.array_distinct("_w")) < F.size("_w"))
    pairs = F.sort_array(F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_sorted", F.when(F.col("_repeats"), pairs)).drop("_w")
    s = F.col("_sorted")
    found = F.filter(
        s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
    )
    df = df.withColumn("_at", F.sort_array(F.transform(found, lambda x: x["i"]))).drop("_sorted")
    # Words under repeated windows: each window adds what the one before it does not cover.
    new = F.transform("_at", lambda p, k: F.when(k == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), p - F.get("_at", k - 1))))
    covered = F.aggregate(new, F.lit(0), lambda a, x: a + x)
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_at", "_repeats")

    def share(part: str, whole: str) -> Column:
        return F.least(F.coalesce(F.expr(f"(1000 * {part}) div nullif({whole}, 0)"), F.lit(0)), F.lit(TOP)).cast("int")

    length = share("word_chars", "n_words")
    measures = {
        "symbols": share("n_symbols", "n_words"), "repeats": share("n_repeat_words", "n_words"),
        "lines": share("n_dup_lines", "_n_lines"), "capitals": share("_capitals", "word_chars"), "long_words": length,
        "short_words": F.when(F.col("n_words") > 0, TOP - length).otherwise(0).cast("int"),
    }
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.select(
        key, "_stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        *(m.alias(f"m_{name}") for name, m in measures.items()),
    )


def allowed_rejections(n: str, alpha: float, delta: float) -> Column:
    """The largest k with P(Bin(n, alpha) <= k) <= delta, or -1; terms are summed as logarithms."""
    add = "greatest(s.c, s.t) + log1p(exp(least(s.c, s.t) - greatest(s.c, s.t)))"
    return F.expr(
        f"aggregate(sequence(0L, cast(ceil({alpha!r}D * {n}) as bigint)),"
        f" named_struct('t', {n} * ln(1D - {alpha!r}D), 'c', double('-infinity'), 'k', -1L),"
        f" (s, i) -> named_struct('t', s.t + ln(double({n} - i) / (i + 1)) + ln({alpha!r}D / (1D - {alpha!r}D)), 'c', {add},"
        f" 'k', case when {add} <= ln({delta!r}D) then i else s.k end), s -> s.k)"
    )


def level_of(floors: dict[str, int], divide: str = "div") -> str:
    """SQL of the strictest level at which no rule rejects a document."""
    each = (f"CASE WHEN m_{r} > {f} THEN (CAST(m_{r} - {f} AS BIGINT) * {TOP} + {TOP - f - 1}) {divide} {TOP - f} ELSE 0 END" for r, f in floors.items())
    return f"greatest({', '.join(['0', *each])})"


def certified_cutoffs(
    measured: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", alpha: float = ALPHA, delta: float = DELTA,
    floors: dict[str, int] = FLOORS,
) -> DataFrame:
    """``_stratum, rule, n_good, allowed, level, cutoff`` for every stratum with labels; level and cutoff are null where none is certified.

    A document labelled twice counts once, and as good if any label says so; null
    labels and labels without a document count for nothing.  One fold of the
    documents in five stays out, so that the risk can be measured on it.  What is
    ranked is one row per stratum and level, at most ``TOP`` and one of these, whatever the corpus holds.
    """
    good = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("_q")).where("_q = 1")
    held = measured.where(~fold_held_out(key, CALIBRATION_FOLDS)).join(good.select(key), key, "left_semi")
    counts = settle(held.groupBy("_stratum", F.expr(level_of(floors)).alias("level")).agg(F.count("*").alias("n")), "label-counts")
    strata = max(1, counts.select("_stratum").distinct().count())
    of_stratum = Window.partitionBy("_stratum")
    above = F.sum("n").over(of_stratum.orderBy(F.desc("level"))) - F.col("n")
    ranked = counts.select("_stratum", "level", F.sum("n").over(of_stratum).alias("n_good"), above.alias("_above"))
    totals = ranked.select(F.col("_stratum").alias("_s"), F.col("n_good").alias("_n")).distinct()
    totals = totals.select("_s", allowed_rejections("_n", alpha, delta / strata).alias("allowed"))
    best = ranked.join(totals, F.col("_s").eqNullSafe(F.col("_stratum"))).groupBy("_stratum").agg(
        F.first("n_good").alias("n_good"), F.first("allowed").alias("allowed"),
        F.min(F.when(F.col("_above") <= F.col("allowed"), F.col("level"))).alias("level"),
    )
    cutoffs = (F.struct(F.lit(r).alias("rule"), F.expr(f"{f} + (level * {TOP - f}) div {TOP}").alias("cutoff")) for r, f in floors.items())
    return best.select("_stratum", "n_good", "allowed", "level", F.explode(F.array(*cutoffs)).alias("_c")).select(
        "_stratum", "_c.rule", "n_good", "allowed", "level", "_c.cutoff"
    )


def judge(measured: DataFrame, cutoffs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``measured`` with the verdict ``kept``; strata without cutoffs keep all that passes the base rule."""
    rules = [c.removeprefix("m_") for c in measured.columns if c.startswith("m_")]
    per = cutoffs.groupBy(F.col("_stratum").alias("_s")).agg(*(F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"c_{r}") for r in rules))
    joined = measured.join(settle(per, "cutoffs"), F.col("_s").eqNullSafe(F.col("_stratum")), "left")
    rejected = F.lit(False)
    for r in rules:
        rejected = rejected | F.coalesce(F.col(f"m_{r}") > F.col(f"c_{r}"), F.lit(False))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return joined.select(key, *counts, "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"))


def quality_rules(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang", **levels) -> DataFrame:
    """Counts and verdict of every document; see the module for the guarantee."""
    with scratch():
        measured = settle(measure(docs, key, text, stratum), "measures", outlives=True)
        cutoffs = settle(certified_cutoffs(measured, labels, key, **levels), "certified", outlives=True)
    return judge(measured, cutoffs, key)


def _oracle() -> str:
    level = level_of(FLOORS, "//")
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, t, regexp_extract_all(t, '{WORD_CLASS}+') AS ws,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{WORD_CLASS}')) AS ls FROM d),
c AS (SELECT *, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '{SPACE_CLASS}', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS caps, len(ls) AS n_lines,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines FROM w),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i,
             unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS s FROM c WHERE len(ws) >= 5),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM h WHERE n > 1) GROUP BY doc_id),
f AS (SELECT c.doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, caps, n_lines
      FROM c LEFT JOIN r USING (doc_id)),
m AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
             least({TOP}, coalesce(1000 * n_symbols // nullif(n_words, 0), 0)) AS m_symbols,
             least({TOP}, coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0)) AS m_repeats,
             least({TOP}, coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0)) AS m_lines,
             least({TOP}, coalesce(1000 * caps // nullif(word_chars, 0), 0)) AS m_capitals,
             least({TOP}, coalesce(1000 * word_chars // nullif(n_words, 0), 0)) AS m_long_words,
             CASE WHEN n_words > 0 THEN {TOP} - least({TOP}, 1000 * word_chars // n_words) ELSE 0 END AS m_short_words FROM f),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1),
held AS (SELECT lang, {level} AS b FROM m JOIN good USING (doc_id) JOIN crc USING (doc_id) WHERE NOT held_out),
cnt AS (SELECT lang, b, count(*) AS n FROM held GROUP BY ALL),
rk AS (SELECT lang, b, sum(n) OVER (PARTITION BY lang) AS n_good,
              sum(n) OVER (PARTITION BY lang ORDER BY b DESC) - n AS above FROM cnt),
tot AS (SELECT DISTINCT lang, n_good FROM rk),
term AS (SELECT lang, n_good, unnest(range(0, ceil({ALPHA!r} * n_good)::BIGINT + 1)) AS i FROM tot),
lt AS (SELECT lang, i, n_good * ln(1 - {ALPHA!r}) + coalesce(sum(CASE WHEN n_good > i THEN ln((n_good - i) / (i + 1)) + ln({ALPHA!r} / (1 - {ALPHA!r})) END)
         OVER (PARTITION BY lang ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS t FROM term),
cdf AS (SELECT lang, i, sum(exp(t)) OVER (PARTITION BY lang ORDER BY i) AS p FROM lt),
ok AS (SELECT lang, coalesce(max(i) FILTER (p <= {DELTA!r} / (SELECT count(DISTINCT coalesce(lang, chr(0))) FROM tot)), -1) AS k FROM cdf GROUP BY ALL),
cut AS (SELECT rk.lang, min(b) AS c FROM rk JOIN ok ON rk.lang IS NOT DISTINCT FROM ok.lang WHERE above <= k GROUP BY ALL),
v AS (SELECT m.doc_id, bool_or({level} > cut.c) AS bad
      FROM m JOIN cut ON m.lang IS NOT DISTINCT FROM cut.lang GROUP BY m.doc_id)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(bad, false) AS kept
FROM m LEFT JOIN v USING (doc_id)"""


def crc32_sql(expression: str, modulus: int, fold: int = 2) -> str:
    """``crc32(text of expression) mod modulus = fold`` in DuckDB, which has no crc32: byte by byte with eight shifts each."""
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    eight = f"list_reduce(list_prepend(xor(acc, ascii(ch)), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: {step})"
    text = f"({expression})::VARCHAR"
    whole = f"list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)), lambda acc, ch: {eight.replace('ascii(ch)', 'ch')})"
    return f"xor({whole}, 4294967295) % {modulus} = {fold}"


ORACLE = _oracle().replace("WITH d AS", f"WITH crc AS (SELECT doc_id, {crc32_sql('doc_id', CALIBRATION_FOLDS)} AS held_out FROM documents),\nd AS", 1)


@register("op10_quality", ORACLE)
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document counted and judged by cutoffs certified per language."""
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
