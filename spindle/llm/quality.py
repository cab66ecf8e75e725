"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Base columns are counts of the text's words, symbols, repeated lines and
repeated 8-word windows. The method's rules compare ratios of them with
cutoffs that labelled documents select. In each stratum (language) and for
each rule, a cutoff is admissible if the exact binomial test shows that the
rule falsely rejects less than ``RISK`` / rules of the good documents:
P(X <= k; n, RISK / rules) <= ``ERROR`` / (rules x strata), where k of the n good
labelled ones lie beyond it (Bonferroni over rules and strata; along the cutoffs
of one rule the tests are nested, from the loosest down, and need no further
correction). Of the admissible cutoffs, the one that best separates the labelled
documents is taken; where none catches more bad than good ones, the rule is off.

Defined results: null texts have no words and fail the base rule; documents
of strata without cutoffs keep the base verdict; a null language is a
stratum of its own; repeated rows are judged alike; labels for absent documents and
null labels teach nothing; an empty table gives an empty result; ``keep`` returns all
columns as they came.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import scratch_table

BLANK = " \t\n\x0b\f\r"
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 8
RISK, ERROR = 0.01, 0.05
MOST_STRATA = 10_000  # beyond it, the table of cutoffs is not broadcast

# Rule -> value over the base columns, and its cutoffs (reject above).
RULES = {
    "symbols": ("n_symbols / n_words", [i / 20 for i in range(1, 61)]),
    "lines": ("n_dup_lines / n_lines", [i / 50 for i in range(50)]),
    "repeats": ("n_repeat_words / n_words", [i / 100 for i in range(31)]),
    "length": ("word_chars / n_words", [i / 2 for i in range(8, 80)]),
}


def base_columns(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text column, plus n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    others = [c for c in df.columns if c != text]
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    body = F.btrim(t, F.lit(BLANK))
    empty = F.array().cast("array<string>")
    has_word = lambda line: F.btrim(line, F.lit(BLANK)) != ""
    # Arrays that a lambda reads at other positions are columns of an own step: evaluated once per row.
    df = df.select(*others, (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                   F.when(body == "", empty).otherwise(F.split(body, GAP)).alias("w"),
                   F.filter(F.split(t, "\n"), has_word).alias("l"))
    df = df.select(*others, F.size("w").cast("long").alias("n_words"),
                   F.length(F.array_join("w", "")).cast("long").alias("word_chars"), "n_symbols",
                   F.size("l").cast("long").alias("n_lines"),
                   (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
                   F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    kept = [*others, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    at = lambda i: F.xxhash64(*[F.get(F.col("h"), i + j) for j in range(WINDOW)])
    none = F.array().cast("array<bigint>")
    df = df.select(*kept, F.when(F.size("h") < WINDOW, none).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size("h") - WINDOW, F.lit(0))), at)).alias("x"))
    nothing = F.array().cast("array<struct<x:bigint,i:int>>")
    df = df.select(*kept, F.when(F.size("x") == F.size(F.array_distinct("x")), nothing).otherwise(
        F.sort_array(F.transform("x", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).alias("s"))
    df = df.select(*kept, "s", F.zip_with("s", F.slice("s", 2, F.greatest(F.size("s"), F.lit(1))), lambda a, b:
                                          F.coalesce(a["x"] == b["x"], F.lit(False))).alias("e"))
    twice = F.zip_with("e", F.slice(F.concat(F.array(F.lit(False)), "e"), 1, F.greatest(F.size("e"), F.lit(1))), lambda a, b: a | b)
    df = df.select(*kept, F.sort_array(F.filter(
        F.zip_with("s", twice, lambda s, on: F.when(on, s["i"])), lambda i: i.isNotNull())).alias("p"))
    step = F.zip_with("p", F.slice("p", 2, F.greatest(F.size("p"), F.lit(1))), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    df = df.select(*kept, F.aggregate(step, F.lit(0), lambda a, b: a + b).cast("long").alias("n_repeat_words"))
    # Filters on these columns stay above this node; pushed below it, they would repeat the whole computation.
    return df.observe(f"quality-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("n"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _value(rule: str) -> Column:
    over, under = RULES[rule][0].split(" / ")
    return F.coalesce(F.col(over) / F.nullif(F.col(under), F.lit(0)), F.lit(0.0))


def binomial_at_most(k: Column, n: Column, p: float) -> Column:
    """P(X <= k), summed in logarithms; 1 without summing where k is beyond the mean."""
    odds = F.log(F.lit(p / (1 - p)))
    none = F.log(F.lit(1 - p)) * n

    def add(acc: Column, j: Column) -> Column:
        term = acc["term"] + F.log((n - j + 1) / j) + odds
        top = F.greatest(acc["sum"], term)
        return F.struct(term.alias("term"), (top + F.log(F.exp(acc["sum"] - top) + F.exp(term - top))).alias("sum"))

    total = F.aggregate(F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")),
                        F.struct(none.alias("term"), none.alias("sum")), add, lambda acc: F.exp(acc["sum"]))
    return F.when(k > n * p, F.lit(1.0)).otherwise(total)


def cutoffs(rows: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, one cutoff per rule or null) from rows (doc_id, lang, base columns) and labels (doc_id, quality)."""
    known = labels.where("quality is not null and doc_id is not null").select(
        "doc_id", (F.col("quality") == 1).alias("good"))

    def exceeded(rule: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(float(c)) for c in RULES[rule][1]]), lambda c: _value(rule) > c))

    # The number of cutoffs that a value exceeds; the counts beyond each follow by summing from the top.
    beyond = F.array(*[F.struct(F.lit(r).alias("rule"), exceeded(r).alias("above")) for r in RULES])
    held = (rows.where(~base_failed()).join(known, "doc_id")
            .select("lang", "good", F.explode(beyond).alias("b"))
            .groupBy("lang", "b.rule", "b.above").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")))
    grid = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(i).alias("i"), F.lit(float(c)).alias("cutoff"))
                     for r in RULES for i, c in enumerate(RULES[r][1])])
    strata = held.groupBy("lang").agg(F.collect_list(F.struct("rule", "above", "good", "bad")).alias("cells"))
    n_strata = F.lit(max(1, strata.count()))
    total = lambda cells, what: F.aggregate(F.transform(cells, lambda c: c[what]), F.lit(0).cast("long"), lambda a, b: a + b)
    tests = strata.select("lang", "cells", F.explode(grid).alias("g")).select(
        "lang", "g.rule", "g.cutoff",
        total(F.filter("cells", lambda c: c["rule"] == F.col("g.rule")), "good").alias("n"),
        total(F.filter("cells", lambda c: c["rule"] == F.col("g.rule")), "bad").alias("n_bad"),
        total(F.filter("cells", lambda c: (c["rule"] == F.col("g.rule")) & (c["above"] > F.col("g.i"))), "good").alias("k"),
        total(F.filter("cells", lambda c: (c["rule"] == F.col("g.rule")) & (c["above"] > F.col("g.i"))), "bad").alias("caught"))
    share = len(RULES)
    # A cutoff that rejects as large a share of the good as of the bad is of no use.
    gain = F.col("caught") / F.greatest("n_bad", F.lit(1)) - F.col("k") / F.greatest("n", F.lit(1))
    passed = (tests.where((F.col("n") > 0) & (gain > 0))
              .where(binomial_at_most(F.col("k"), F.col("n"), risk / share) <= F.lit(error / share) / n_strata))
    return passed.groupBy("lang").agg(*[
        F.max_by(F.when(F.col("rule") == r, F.col("cutoff")),
                 F.when(F.col("rule") == r, F.struct(F.round(gain, 9), "cutoff"))).alias(f"cut_{r}") for r in RULES])


def judge(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` (with lang and base columns) plus base_failed and kept."""
    cuts = cuts.withColumnRenamed("lang", "stratum")
    if cuts.limit(MOST_STRATA + 1).count() <= MOST_STRATA:
        cuts = F.broadcast(cuts)
    beyond = [F.coalesce(_value(r) > F.col(f"cut_{r}"), F.lit(False)) for r in RULES]
    judged = rows.join(cuts, F.col("lang").eqNullSafe(F.col("stratum")), "left")
    return (judged.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~reduce(lambda a, b: a | b, beyond))
            .drop("stratum", *[f"cut_{r}" for r in RULES]))


def rate(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per document: doc_id, base columns, base_failed, kept."""
    rows = scratch_table(base_columns(docs.select("doc_id", "lang", "text")), "quality")
    return judge(rows, scratch_table(cutoffs(rows, labels, risk, error), "cutoffs")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "lang", "text")
    rows = scratch_table(base_columns(whole), "quality")
    cuts = scratch_table(cutoffs(rows, labels, risk, error), "cutoffs")
    return judge(rows, cuts).where("kept").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
