"""Quality rules combined by weak supervision.

Rules look at counts of a text. Each votes good (1), bad (-1) or abstains (0);
most rules only speak up against a text, as passing a check says little. The
share of each kind of vote among good and among bad texts is unknown.
Expectation-maximisation estimates it together with the share of good texts,
from the votes of all texts: texts with the same votes are one pattern, so a
step works on at most 3^rules rows, whatever the number of texts. A text is
kept if its posterior probability of being good reaches ``threshold`` and it
fails none of the base rules.

Only DataFrame functions are used. Words are runs of anything but space and
0x09-0x0D; counts are of code points. Null text counts as empty: no words, so
the base rules fail. Rows are kept one by one, whatever their ids. Texts
of any length are taken whole. Without rows the estimate is the start value.
Equal texts get equal verdicts; a posterior equal to ``threshold`` is kept.
Windows of words are compared by 64-bit hashes within a text: among a million
windows, the chance of a false repeat is 3 in 10^8. Only the columns named are
read, so other columns can't clash.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from roomtide.llm.text import one_column
from roomtide.session import scratch_path

WHITE, WORD_CHAR = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def with_repeated_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """Add the number of words in windows of three that occur twice or more in the array ``words``, the first occurrence included.

    Windows are numbered and sorted by hash, so equal ones stand side by side.
    Each step is a projection of its own, as Spark evaluates an expression
    once where later projections use it several times; texts without an equal window skip the sort.
    """
    n = F.size(words)
    behind = lambda k: F.slice(words, k, F.greatest(n, F.lit(1)))
    triples = F.slice(F.arrays_zip(F.col(words).alias("a"), behind(2).alias("b"), behind(3).alias("c")), F.lit(1), F.greatest(n - 2, F.lit(0)))
    none = F.array().cast("array<int>")
    kept = [c for c in df.columns if c != out]
    grams = df.select(*kept, F.transform(triples, lambda t: F.xxhash64(t["a"], t["b"], t["c"])).alias("__grams"))
    several = grams.select(*kept, F.when(F.size(F.array_distinct("__grams")) < F.size("__grams"), F.col("__grams")).otherwise(F.array().cast("array<bigint>")).alias("__grams"))
    placed = several.select(*kept, F.sort_array(F.transform("__grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))).alias("__placed"))
    beside = F.arrays_zip(F.col("__placed").alias("x"), F.slice("__placed", F.lit(2), F.greatest(F.size("__placed"), F.lit(1))).alias("y"))
    equal = placed.select(*kept, F.filter(beside, lambda p: p["x"]["g"] == p["y"]["g"]).alias("__equal"))
    starts = equal.select(*kept, F.when(F.size("__equal") > 0, F.array_union(F.transform("__equal", lambda p: p["x"]["i"]), F.transform("__equal", lambda p: p["y"]["i"]))).otherwise(none).alias("__starts"))
    covered = F.array_union(F.array_union("__starts", F.transform("__starts", lambda i: i + 1)), F.transform("__starts", lambda i: i + 2))
    return starts.select(*kept, F.when(F.size("__starts") > 0, F.size(covered)).otherwise(0).cast("bigint").alias(out))


def counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts that rules look at, of ``doc_id`` and ``text``."""
    text = F.col("text")
    times = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("bigint")
    parts = docs.withColumn("text", F.coalesce("text", F.lit(""))).select(
        "doc_id", "text", F.array_remove(F.split("text", WHITE + "+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD_CHAR)).alias("lines"),
    )
    counted = parts.select(
        "doc_id",
        "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        times(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("lines").cast("bigint").alias("n_lines"),
        times(r"[A-Z]").alias("n_capitals"),
        times(r"[!?]{2}").alias("n_shouts"),
        times(r"\|").alias("n_bars"),
        times(r"[.,;:]").alias("n_stops"),
        F.size(F.array_distinct("words")).cast("bigint").alias("n_distinct"),
    )
    return with_repeated_words(counted, "words", "n_repeat_words").drop("words")


def votes() -> dict[str, Column]:
    """The rules as SQL over the counts: -1 bad, 1 good, 0 abstains."""
    w, chars = "greatest(n_words, 1)", "greatest(word_chars, 1)"
    rules = {
        "symbols": f"case when n_symbols > 0.05 * {chars} then -1 else 0 end",
        "symbol_words": f"case when n_symbols > 0.25 * {w} then -1 when n_symbols <= 0.01 * {w} then 1 else 0 end",
        "capitals": f"case when n_capitals > 0.4 * {chars} then -1 else 0 end",
        "shouts": f"case when n_shouts > 0.2 * {w} then -1 when n_shouts <= 0.005 * {w} then 1 else 0 end",
        "bars": f"case when n_bars > 0.2 * {w} then -1 else 0 end",
        "repeats": f"case when n_repeat_words > 0.4 * {w} then -1 when n_repeat_words <= 0.1 * {w} then 1 else 0 end",
        "variety": f"case when n_words >= 40 and n_distinct < 0.3 * n_words / (1 + ln({w}) / 8) then -1 when n_distinct > 0.5 * {w} then 1 else 0 end",
        "lines": "case when n_lines >= 4 and n_dup_lines > 0.3 * n_lines then -1 else 0 end",
        "stops": f"case when n_words >= 20 and (n_stops < 0.01 * {w} or n_stops > 0.8 * {w}) then -1 when n_stops between 0.04 * {w} and 0.4 * {w} then 1 else 0 end",
    }
    return {name: F.expr(rule).cast("int") for name, rule in rules.items()}


class Estimate:
    """Share of good texts, and for each rule the shares of its votes among good and bad texts."""

    def __init__(self, rules: Sequence[str]):
        self.good = 0.8
        # start: a rule's good votes lean to good texts, its bad votes to bad ones
        self.shares = {r: {1: {-1: 0.01, 0: 0.44, 1: 0.55}, 0: {-1: 0.3, 0: 0.25, 1: 0.45}} for r in rules}

    def log_odds(self) -> Column:
        total = F.lit(math.log(self.good / (1 - self.good)))
        for r, s in self.shares.items():
            ratio = {v: math.log(s[1][v] / s[0][v]) for v in (-1, 0, 1)}
            total = total + F.when(F.col(r) == -1, ratio[-1]).when(F.col(r) == 1, ratio[1]).otherwise(ratio[0])
        return total

    def posterior(self) -> Column:
        return 1 / (1 + F.exp(-self.log_odds()))


def estimate(patterns: DataFrame, rules: Sequence[str], steps: int = 300, prior_rows: float = 10.0, tolerance: float = 1e-6) -> Estimate:
    """Expectation-maximisation over vote patterns and their ``n``; each share is smoothed with ``prior_rows`` rows of its start value.

    It ends when no share of a vote, nor that of good texts, moves by
    ``tolerance``; a warning says so if it hasn't after ``steps``.
    """
    found, start, moved = Estimate(rules), Estimate(rules), math.inf
    for _ in range(steps):
        weighed = patterns.withColumn("p", found.posterior())
        sums = [F.coalesce(F.sum(F.col("n") * F.col("p")), F.lit(0.0)).alias("good"), F.coalesce(F.sum("n"), F.lit(0)).alias("all")]
        for r in rules:
            for v in (-1, 0, 1):
                here = F.when(F.col(r) == v, F.col("n")).otherwise(0)
                sums += [F.coalesce(F.sum(here * F.col("p")), F.lit(0.0)).alias(f"{r}_{v}_1"), F.coalesce(F.sum(here * (1 - F.col("p"))), F.lit(0.0)).alias(f"{r}_{v}_0")]
        row = weighed.agg(*sums).first()
        good, everything, before = row["good"], row["all"], found
        found = Estimate(rules)
        found.good = (good + prior_rows * start.good) / (everything + prior_rows)
        for r in rules:
            for y, size in ((1, good), (0, everything - good)):
                found.shares[r][y] = {v: (row[f"{r}_{v}_{y}"] + prior_rows * start.shares[r][y][v]) / (size + prior_rows) for v in (-1, 0, 1)}
        moved = max(abs(found.good - before.good), *(abs(found.shares[r][y][v] - before.shares[r][y][v]) for r in rules for y in (0, 1) for v in (-1, 0, 1)))
        if moved < tolerance:
            break
    if moved >= tolerance:
        warnings.warn(f"after {steps} steps a share still moves by {moved:.3g}", stacklevel=2)
    return found


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per row the counts, ``base_failed``, the ``posterior`` probability of being good, and ``kept``."""
    rules = votes()
    path = scratch_path(docs.sparkSession, "counts")
    counts(one_column(docs, doc_id=doc_id, text=text)).write.parquet(path)
    counted = docs.sparkSession.read.parquet(path)
    stored = counted.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *(c.alias(f"vote_{r}") for r, c in rules.items()))
    names = [f"vote_{r}" for r in rules]
    patterns_path = scratch_path(docs.sparkSession, "patterns")
    stored.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1).write.parquet(patterns_path)
    found = estimate(docs.sparkSession.read.parquet(patterns_path), names)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stored.withColumn("base_failed", failed).withColumn("posterior", found.posterior()).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
