"""Quality rules with risk-controlled cutoffs.

Every rule scores a text and rejects it above a cutoff. The rules' cutoffs
go together in levels, from the mildest to the strictest of a fixed grid, and
a text is rejected at a level if any rule rejects it there. Levels are
certified on labelled texts, separately in each stratum (a language): with k
of n good texts rejected at a level, the exact binomial probability of seeing
k or fewer if the true share of good texts lost were ``RISK`` must be at most
``ERROR`` divided by the number of strata (Bonferroni). Levels are tested in
their fixed order and the first one that fails ends the testing, which needs
no correction over the levels. So with probability 1 - ``ERROR`` there is no
stratum in which the rules together reject more than ``RISK`` of the good
texts. Among the certified levels a stratum takes the one that catches most
bad texts for the good ones it costs (the milder one of equals); without one
that gains anything, its texts are rejected by the base rule only. To certify
a level that loses none of its good texts, a stratum needs
ln(ERROR / strata) / ln(1 - RISK) of them: 436 with four strata.

The bound is on texts that pass the base rule; what that one rejects, it
rejects in any case.

Everything is DataFrame functions. The texts are scored where they lie; only
scores and labels are joined. The levels are joined by stratum, broadcast
if there are no more than ``SMALL`` strata with any.

Null texts have no words and fail the base rule. A null language is a
stratum of its own; a stratum without labelled texts has no level. A null
label is none; of contradicting labels of one document, the good
one counts. Repeated rows each give their row. Further columns of the
documents go through ``keep`` unchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reglink.llm import frames

RISK = 0.01
ERROR = 0.05
SMALL = 10_000
PRICE = 20.0  # good texts lost count this much more than bad texts caught
SPACE = r"[\x20\x09-\x0D]+"
GRID = {
    "symbols": [0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3, 0.5],
    "dup_lines": [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.8],
    "repeats": [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5],
    "upper": [0.05, 0.08, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7, 0.9],
}
RULES = list(GRID)
# LEVELS[j][rule] is the rule's cutoff at level j; the mildest level is 0.
LEVELS = [dict(zip(GRID, cut, strict=True)) for cut in zip(*[sorted(x, reverse=True) for x in GRID.values()], strict=True)]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the counts of the base rules, and ``__n_lines`` and
    ``__n_upper``, added (names in ``COUNTS``, prefixed with ``__``)."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    words = F.array_remove(F.split(body, SPACE, -1), "")
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumns({"__w": words, "__l": lines})
    # Hash and place of every 3-word window, then those next to an equal one.
    window = lambda i: F.struct(F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)).alias("h"), i.alias("i"))
    out = out.withColumn("__s", F.when(F.size("__w") >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), F.size("__w") - 3), window))).otherwise(F.array()))
    twin = lambda x, j: (x.h == F.get("__s", j - 1).h) | (x.h == F.get("__s", j + 1).h)
    out = out.withColumn("__p", F.sort_array(F.transform(F.filter("__s", twin), lambda x: x.i)))
    covers = F.transform("__p", lambda x, j: F.least(F.lit(3), F.coalesce(F.get("__p", j + 1) - x, F.lit(3))))
    counts = {
        "__n_words": F.size("__w").cast("bigint"),
        "__word_chars": F.length(F.array_join("__w", "")).cast("bigint"),
        "__n_symbols": F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("bigint"),
        "__n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("bigint"),
        "__n_repeat_words": F.aggregate(covers, F.lit(0), lambda a, x: a + x).cast("bigint"),
        "__n_lines": F.size("__l").cast("bigint"),
        "__n_upper": F.regexp_count(body, F.lit(r"\p{Lu}")).cast("bigint"),
    }
    # As a generator's output the counts are made once a row: a filter above
    # is not moved below them, where it would write their lambdas out again.
    one = F.explode_outer(F.array(F.struct(*[c.alias(n) for n, c in counts.items()])))
    return out.withColumn("__m", one).select(*[F.col(f"`{c}`") for c in docs.columns], "__m.*")


def base_failed() -> Column:
    return (F.col("__n_words") < 50) | (100 * F.col("__n_repeat_words") > 50 * F.col("__n_words"))


def scores() -> dict[str, Column]:
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {
        "symbols": share("__n_symbols", "__word_chars"),
        "dup_lines": share("__n_dup_lines", "__n_lines"),
        "repeats": share("__n_repeat_words", "__n_words"),
        "upper": share("__n_upper", "__word_chars"),
    }


def stratum(lang: str) -> Column:
    return F.when(F.col(f"`{lang}`").isNull(), "null").otherwise(F.concat(F.lit("="), F.col(f"`{lang}`").cast("string")))


def _ln_factorial(x: Column) -> Column:
    x = x.cast("double")
    series = (x + 0.5) * F.ln(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return F.when(x < 20, F.ln(F.factorial(F.least(x, F.lit(20.0)).cast("int")).cast("double"))).otherwise(series)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X of n trials with probability p, at k <= n p (else 1).
    Terms fall off downwards from k, so those further below than twelve
    standard deviations (and 50) are too small to matter."""
    n, k = n.cast("bigint"), k.cast("bigint")
    reach = F.ceil(12 * F.sqrt(n * p * (1 - p))).cast("bigint") + 50
    term = lambda i: F.exp(_ln_factorial(n) - _ln_factorial(i) - _ln_factorial(n - i) + i * math.log(p) + (n - i) * math.log1p(-p))
    total = F.aggregate(F.sequence(F.greatest(F.lit(0).cast("bigint"), k - reach), k), F.lit(0.0), lambda a, i: a + term(i))
    return F.when(k <= n * p, total).otherwise(F.lit(1.0))


def first_level() -> Column:
    """The mildest level at which any rule rejects a text, as a number; the
    number of levels if none does. Stricter levels reject it as well."""
    passed = [F.size(F.filter(F.array(*[F.lit(x[rule]) for x in LEVELS]), lambda c: score <= c)) for rule, score in scores().items()]  # noqa: B023
    return F.least(*passed)


def certify(measured: DataFrame, labels: DataFrame, lang: str = "lang", key: str = "doc_id", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, level, n, k, n_bad, bad, p, certified): every test. Of n good
    texts k are rejected at the level, of n_bad bad ones bad."""
    good = labels.select(F.col("doc_id").alias("__key"), F.col("quality").alias("__q")).where("__key IS NOT NULL AND __q IS NOT NULL").groupBy("__key").agg(F.max("__q").alias("__good"))
    scored = measured.where(~base_failed()).select(F.col(key).alias("__key"), stratum(lang).alias("stratum"), first_level().alias("first"))
    fine = F.col("__good") == 1
    sums = []
    for j in range(len(LEVELS)):
        sums += [F.count_if(fine & (F.col("first") <= j)).alias(f"k{j}"), F.count_if(~fine & (F.col("first") <= j)).alias(f"b{j}")]
    counted = scored.join(good, "__key").groupBy("stratum").agg(F.count_if(fine).alias("n"), F.count_if(~fine).alias("n_bad"), *sums)
    tests = F.array(*[F.struct(F.lit(j).alias("level"), F.col(f"k{j}").alias("k"), F.col(f"b{j}").alias("bad")) for j in range(len(LEVELS))])
    long = counted.select("stratum", "n", "n_bad", F.inline(tests))
    long = frames.keep(long.withColumn("p", binomial_tail(F.col("n"), F.col("k"), risk)))
    strata = long.select("stratum").distinct().count()
    # The first test that fails ends the sequence.
    so_far = W.partitionBy("stratum").orderBy("level").rowsBetween(W.unboundedPreceding, W.currentRow)
    return long.withColumn("certified", F.max("p").over(so_far) <= error / max(1, strata))


def cutoffs(tests: DataFrame, price: float = PRICE) -> DataFrame:
    """(stratum, __level): of every stratum, the chosen level, or null."""
    gain = F.col("bad") / F.greatest("n_bad", F.lit(1)) - price * F.col("k") / F.greatest("n", F.lit(1))
    usable = F.when(F.col("certified") & (gain > 0), F.struct(gain.alias("gain"), (-F.col("level")).alias("mild")))
    return tests.groupBy("stratum").agg((-F.max(usable)["mild"]).alias("__level"))


def judge(measured: DataFrame, chosen: DataFrame, lang: str = "lang") -> DataFrame:
    """The measured rows with ``__base_failed``, ``__failed`` (the rules that
    reject) and ``__kept`` added."""
    table = frames.keep(chosen.where("__level IS NOT NULL").select(F.col("stratum").alias("__stratum"), "__level"))
    table = F.broadcast(table) if table.count() <= SMALL else table
    cut = {rule: F.get(F.array(*[F.lit(x[rule]) for x in LEVELS]), F.col("__level")) for rule in RULES}
    failed = F.array_compact(F.array(*[F.when(score > cut[rule], F.lit(rule)) for rule, score in scores().items()]))
    columns = [F.col(f"`{c}`") for c in measured.columns]
    joined = measured.join(table, stratum(lang) == F.col("__stratum"), "left")
    out = joined.select(*columns, base_failed().alias("__base_failed"), failed.alias("__failed"))
    return out.withColumn("__kept", ~F.col("__base_failed") & (F.size("__failed") == 0))


def keep(docs: DataFrame, labels: DataFrame, lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """The documents that the rules keep, as they were, whatever the names of
    their columns. The texts are measured once, into a kept table."""
    flat, key, lang, text = frames.numbered(docs), frames.at(docs, key), frames.at(docs, lang), frames.at(docs, "text")
    measured = frames.keep(measures(flat, text))
    kept = judge(measured, cutoffs(certify(measured, labels, lang, key)), lang).where("__kept")
    return kept.select(*flat.columns).toDF(*docs.columns)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    measured = frames.keep(measures(docs).drop("text"))
    chosen = cutoffs(certify(measured, frames.read(spark, sf_dir, "labels")))
    judged = judge(measured, chosen)
    return judged.select("doc_id", *[F.col(f"__{c}").alias(c) for c in COUNTS], F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"), F.array_join("__failed", ",").alias("failed_rules"))
