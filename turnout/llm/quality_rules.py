"""Weak supervision over quality rules, in DataFrame and SQL functions only.

Each rule votes good (1), bad (0) or abstains (null) on a document.  No rule decides alone: the votes
are noisy labels of a hidden class.  Expectation-maximisation over all documents estimates how often
each rule gives each vote on good and on bad documents (its accuracy and coverage), and the posterior
probability of a document's votes replaces the filter that every rule must pass.

The votes of a document are one of at most ``3 ** len(RULES)`` patterns, so the corpus is counted by
pattern once and every EM step is one aggregate over that small table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnout.llm.common import fresh, written

SPACE = r"[\\x20\\x09-\\x0D]+"

# rule -> (condition of a bad vote, condition of a good vote); neither: it abstains
RULES = {
    "length": ("n_words < 50", "n_words >= 100"),
    "word_length": ("word_chars < 3 * n_words OR word_chars > 6.5 * n_words",
                    "word_chars >= 3.5 * n_words AND word_chars <= 6 * n_words"),
    "symbols": ("n_symbols > 0.05 * word_chars", "n_symbols <= 0.005 * word_chars"),
    "bars": ("n_bars > 0.05 * n_words", "n_bars = 0"),
    "repeated_lines": ("n_dup_lines > 0.5 * n_lines", "n_dup_lines = 0"),
    "repeated_words": ("n_repeat_words > 0.3 * n_words", "n_repeat_words <= 0.05 * n_words"),
    "capitals": ("n_capitals > 0.25 * word_chars", "n_capitals <= 0.1 * word_chars"),
    "shouting": ("n_shouts > 0.05 * n_words", "n_shouts = 0"),
}
# where EM starts, and what its prior counts pull to: share of good documents, votes (bad, good) by class
GOOD_SHARE = 0.85
GOOD_VOTES, BAD_VOTES = (0.01, 0.9), (0.35, 0.5)
PRIOR = 0.1  # weight of the prior, in documents per document
STEPS = 12
KEEP = 0.5

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_statistics(docs: DataFrame, p: str) -> DataFrame:
    """``docs`` with one column ``{p}s``: the statistics of ``text`` as a struct of longs (a null text is empty)."""
    kept = [F.col(f"`{c}`") for c in docs.columns]
    out = docs.select(*kept, F.expr(f"array_remove(split(coalesce(text, ''), '{SPACE}', -1), '')").alias(f"{p}words"),
                      F.expr("split(coalesce(text, ''), '\\n', -1)").alias(f"{p}raw"))
    out = out.withColumn(f"{p}lines", F.expr(f"filter({p}raw, x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')")).drop(f"{p}raw")
    # windows of three words as one string each; the last two words start none
    three = (f"zip_with(zip_with(slice({p}words, 1, size({p}words) - 2), slice({p}words, 2, size({p}words) - 2), (a, b) -> concat(a, ' ', b)), "
             f"slice({p}words, 3, size({p}words) - 2), (a, b) -> concat(a, ' ', b))")
    out = out.withColumn(f"{p}three", F.expr(f"if(size({p}words) < 3, array(), {three})"))
    # sorted with their places only where one of them occurs twice
    out = out.withColumn(f"{p}sorted", F.expr(
        f"if(size(array_distinct({p}three)) < size({p}three), sort_array(transform({p}three, (x, i) -> struct(x AS w, i AS i))), null)"))
    out = out.withColumn(f"{p}places", F.expr(
        f"array_distinct(flatten(zip_with(slice({p}sorted, 1, size({p}sorted) - 1), slice({p}sorted, 2, size({p}sorted) - 1), "
        f"(a, b) -> if(a.w = b.w, array(a.i, b.i), array()))))"))
    longs = {
        "n_words": f"size({p}words)",
        "word_chars": f"length(array_join({p}words, ''))",
        "n_symbols": "length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', ''))",
        "n_dup_lines": f"size({p}lines) - size(array_distinct({p}lines))",
        "n_repeat_words": f"if({p}places IS NULL, 0, size(array_distinct(flatten(transform({p}places, x -> array(x, x + 1, x + 2))))))",
        "n_lines": f"size({p}lines)",
        "n_bars": f"size({p}words) - size(array_remove({p}words, '|'))",
        "n_capitals": "length(regexp_replace(coalesce(text, ''), '[^\\\\p{Lu}]+', ''))",
        "n_shouts": "(length(coalesce(text, '')) - length(replace(coalesce(text, ''), '!!', ''))) div 2",
    }
    made = "struct(" + ", ".join(f"cast({e} AS bigint) AS {n}" for n, e in longs.items()) + ")"
    return out.select(*kept, F.expr(made).alias(f"{p}s"))


def votes(statistics: Column | str = "s") -> Column:
    """A struct with the vote of every rule on a struct column of statistics."""
    def on(rule: str) -> str:
        bad, good = (_qualified(x, statistics) for x in RULES[rule])
        return f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 1 END AS {rule}"
    return F.expr("struct(" + ", ".join(map(on, RULES)) + ")")


def _qualified(condition: str, struct: str) -> str:
    names = set(BASE) | {"n_lines", "n_bars", "n_capitals", "n_shouts"}
    return " ".join(f"{struct}.{w}" if w in names else w for w in condition.split(" "))


class VoteModel:
    """Share of good documents, and for each rule the chance of a (bad, good) vote on good and on bad documents."""

    def __init__(self):
        self.share = GOOD_SHARE
        self.good = {r: GOOD_VOTES for r in RULES}
        self.bad = {r: BAD_VOTES for r in RULES}

    def posterior(self, struct: str = "v") -> str:
        """SQL for the probability that a document with these votes is good."""
        terms = [repr(math.log(self.share / (1 - self.share)))]
        for r in RULES:
            (g0, g1), (b0, b1) = self.good[r], self.bad[r]
            weight = [math.log(g0 / b0), math.log(g1 / b1), math.log((1 - g0 - g1) / (1 - b0 - b1))]
            terms.append("CASE {s}.{r} WHEN 0 THEN {0!r}D WHEN 1 THEN {1!r}D ELSE {2!r}D END".format(*weight, s=struct, r=r))
        return f"1D / (1D + exp(-({terms[0]}D + {' + '.join(terms[1:])})))"

    def fit(self, patterns: DataFrame, steps: int = STEPS) -> VoteModel:
        """EM over a table of vote patterns ``v`` with their counts ``n``; an empty table leaves the start values."""
        for _ in range(steps):
            weighed = patterns.select("v", "n", F.expr(f"n * ({self.posterior()})").alias("g"))
            sums = weighed.selectExpr(
                "sum(n) AS n", "sum(g) AS g",
                *(f"sum(if(v.{r} = {k}, n, 0)) AS n_{r}_{k}" for r in RULES for k in (0, 1)),
                *(f"sum(if(v.{r} = {k}, g, 0D)) AS g_{r}_{k}" for r in RULES for k in (0, 1))).first()
            if not sums["n"]:
                break
            n, g, pull = float(sums["n"]), sums["g"], PRIOR * sums["n"]
            self.share = (g + pull * GOOD_SHARE) / (n + pull)
            for r in RULES:
                seen = [(sums[f"g_{r}_{k}"], sums[f"n_{r}_{k}"] - sums[f"g_{r}_{k}"]) for k in (0, 1)]
                self.good[r] = tuple((s[0] + pull * p) / (g + pull) for s, p in zip(seen, GOOD_VOTES))
                self.bad[r] = tuple((s[1] + pull * p) / (n - g + pull) for s, p in zip(seen, BAD_VOTES))
        return self


def fit_votes(judged: DataFrame, struct: str) -> VoteModel:
    """The vote model of a written table with a struct column of statistics."""
    patterns = judged.select(votes(struct).alias("v")).groupBy("v").agg(F.count("*").alias("n")).coalesce(1)
    return VoteModel().fit(written(patterns, "votes"))


def _verdict(model: VoteModel, struct: str) -> tuple[str, str]:
    failed = f"({struct}.n_words < 50 OR 100 * {struct}.n_repeat_words > 50 * {struct}.n_words)"
    return failed, model.posterior("v")


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, probability (that the
    document is good) and kept (probability of at least KEEP, false if base_failed).

    A null or empty text has no words: zero statistics, base_failed.  One row per input row, repeated rows
    and null doc_ids included; other columns are dropped.  An empty table gives an empty result.
    """
    stats = written(with_statistics(docs.select("doc_id", "text"), "q").select("doc_id", F.col("qs").alias("s")), "statistics")
    failed, good = _verdict(fit_votes(stats, "s"), "s")
    return stats.select("doc_id", "s", votes("s").alias("v")).select(
        "doc_id", *(F.col(f"s.{c}").alias(c) for c in BASE), F.expr(failed).alias("base_failed"), F.expr(good).alias("probability")
    ).withColumn("kept", F.expr(f"NOT base_failed AND probability >= {KEEP}"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns."""
    p = fresh("_rule_", docs.columns)
    stats = written(with_statistics(docs, p), "statistics")
    failed, good = _verdict(fit_votes(stats, f"{p}s"), f"{p}s")
    kept = stats.withColumn(f"{p}v", votes(f"{p}s")).filter(F.expr(f"NOT {failed} AND {good.replace('v.', f'{p}v.')} >= {KEEP}"))
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
