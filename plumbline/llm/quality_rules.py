"""Quality rules whose cutoffs are chosen on labelled documents so that few good documents are rejected.

Each rule compares a share measured on the whole text with a cutoff. For each stratum (a column, the language by
default) cutoffs are tightened from lenient to strict, rule after rule, and each time all rules in use are tested together:
they are certified if, were the true share of good documents that any of them rejects as large as ``risk``, so few
rejected ones in the holdout would have at most the allowed probability (an exact binomial bound of Clopper and Pearson).
Rules come in the order of the labelled bad documents that they add, and cutoffs that add none are left out, so what is
tested follows from the bad documents alone and not from the good ones that test it. A sequence stops at the first
failure, which needs no correction along it. Then the rule that failed is set aside, the others go on in a sequence of its
own, and at its end the rules set aside are tightened as far as they can be. The error is split evenly over strata; in
a stratum the first sequence has half of it, those after one failure a quarter together, and so on (all of it where
one rule alone rejects bad documents). So the rules together reject at most ``risk`` of a stratum's good documents, with
probability ``1 - error`` for all strata at once. Of all that is certified, what rejects most labelled bad documents
is used. The grid of cutoffs is fixed. All labels take part.

Defined cases: null text has no words. A stratum without labels, or with too few to certify anything, rejects nothing
beyond the base rules. Null is a stratum of its own. A document labelled more than once is good if all its labels
are 1 and bad if all are 0, else it is not used; labels without an id or a quality are not used. Rows are judged one by
one, so repeated rows and ids get equal verdicts. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.shared import scalar, staged
from plumbline.llm.words import covered, repeated, texts, window_hashes, word_hashes

SYMBOLS = b"#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]
_TYPE = pa.struct([(name, pa.int64()) for name in MEASURES])

#: Each rule's share: a measure over another one.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "upper": ("n_upper", "word_chars"),
    "marks": ("n_marks", "n_words"),
}
#: Cutoffs from lenient to strict; a share above the cutoff rejects.
CUTOFFS = {
    "symbols": [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04],
    "dup_lines": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2],
    "repeats": [0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2],
    "upper": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
    "marks": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
}


@dataclass(frozen=True)
class RiskPlan:
    """``risk``: largest share of a stratum's good documents that the rules may reject together; ``error``: probability
    that any stratum exceeds it."""

    risk: float = 0.02
    error: float = 0.05
    rules: dict = field(default_factory=lambda: RULES)
    cutoffs: dict = field(default_factory=lambda: CUTOFFS)


def measured(text: bytes) -> tuple[int, ...]:
    """The measures of one text, in the order of ``MEASURES``."""
    words = text.split()
    n = len(words)
    chars = sum(map(len, words))
    if not text.isascii():
        chars -= int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) == 0x80))
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeats = 0
    if n >= 3:
        again = np.flatnonzero(repeated(window_hashes(word_hashes(words), 3)))
        repeats = int(np.count_nonzero(covered(again, 3, n))) if len(again) else 0
    upper = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return (n, chars, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeats, len(lines), upper,
            len(text) - len(text.translate(None, b"!?")))


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def measures(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in column:
        rows = np.array([measured(text) for text in texts(batch)], np.int64).reshape(-1, len(MEASURES))
        yield pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(MEASURES))], fields=list(_TYPE))


# Equal for equal texts all the same: else Spark repeats it in every filter on a measure, and each runs in a worker of its own.
measures = measures.asNondeterministic()


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def _share(m: Column, rule: tuple[str, str]) -> Column:
    return m[rule[0]] / F.greatest(m[rule[1]], F.lit(1))


def _passed(share: Column, cutoffs: list[float]) -> Column:
    """How many of the cutoffs the share is above."""
    return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cutoffs]), lambda cutoff: share > cutoff))


def binomial_at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial variable, summed exactly in logarithms."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
            for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def _certified(good: int, n_good: int, risk: float, error: float) -> bool:
    return n_good > 0 and binomial_at_most(good, n_good, risk) <= error


def chosen(cutoffs: list[float], good: list[int], bad: list[int], n_good: int, risk: float, error: float) -> float:
    """The cutoff to use of a rule by itself; infinity for none. ``good`` and ``bad``: documents that each cutoff, lenient first, rejects."""
    best, most = math.inf, 0
    for cutoff, g, b in zip(cutoffs, good, bad):
        if not _certified(g, n_good, risk, error):
            break
        if b > most:
            best, most = cutoff, b
    return best


def joint_levels(passed: np.ndarray, good: np.ndarray, bad: np.ndarray, steps: list[int], risk: float, error: float) -> list[int]:
    """How many of each rule's cutoffs to go through, lenient first (0: rule not used), so that the last of them is used.

    A row of ``passed`` is a kind of document: how many of each rule's ``steps`` cutoffs its share is above. ``good`` and
    ``bad`` count the labelled documents of that kind.
    """
    sizes, n_good = np.array(steps), int(good.sum())
    useful = int(sum(bad[passed[:, k] > 0].sum() > 0 for k in range(len(steps))))

    def rejected(levels: np.ndarray, counts: np.ndarray) -> int:
        return int(counts[((levels > 0) & (passed > sizes - levels)).any(axis=1)].sum())

    def tightened(levels: np.ndarray, k: int) -> list[tuple[int, np.ndarray]]:
        """The steps of rule ``k`` that each reject more bad documents, with their number."""
        out, most = [], rejected(levels, bad)
        for level in range(levels[k] + 1, steps[k] + 1):
            tried = levels.copy()
            tried[k] = level
            if (n := rejected(tried, bad)) > most:
                out.append((n, tried))
                most = n
        return out

    best, most = np.zeros(len(steps), int), 0
    levels, aside = best, []

    def passes(n: int, tried: np.ndarray) -> bool:
        nonlocal best, most
        part = error if useful == 1 else error / 2 ** (len(aside) + 1) / math.perm(useful, len(aside))
        if not _certified(rejected(tried, good), n_good, risk, part):
            return False
        if n > most:
            best, most = tried, n
        return True

    while True:
        sequences = [(k, s) for k in range(len(steps)) if k not in aside and (s := tightened(levels, k))]
        if not sequences:
            break
        k, sequence = max(sequences, key=lambda x: x[1][-1][0])
        if all(passes(n, tried) for n, tried in sequence):
            levels = sequence[-1][1]
        else:
            aside.append(k)
    for k in aside:
        for n, tried in tightened(levels, k):
            if not passes(n, tried):
                return best.tolist()
            levels = tried
    return best.tolist()


def calibrated(measured_docs: DataFrame, labels: DataFrame, plan: RiskPlan, stratum: str = "stratum") -> DataFrame:
    """A row per labelled stratum: ``stratum`` and the cutoff ``cut_<rule>`` of each rule (infinity: not used).

    ``measured_docs``: doc_id, the stratum and the struct ``m``; ``labels``: doc_id, quality.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("_id")) \
        .agg(F.min("quality").alias("_low"), F.max("quality").alias("_high")).where("_low = _high")
    rows = measured_docs.join(known, measured_docs["doc_id"] == known["_id"]).where(~base_failed(F.col("m")))
    passed = F.array(*[_passed(_share(F.col("m"), parts), plan.cutoffs[rule]) for rule, parts in plan.rules.items()])
    # A row per kind of document: at most the product of the rules' cutoffs, whatever the data.
    counts = staged(rows.select(F.col(stratum).alias("stratum"), (F.col("_low") >= 1).alias("good"), passed.alias("passed"))
                    .groupBy("stratum", "passed", "good").agg(F.count(F.lit(1)).alias("n")))
    strata = scalar(counts, F.count_distinct(F.coalesce(F.col("stratum"), F.lit("\0null"))))
    risk, error = plan.risk, plan.error / max(strata, 1)
    cutoffs = {rule: plan.cutoffs[rule] for rule in plan.rules}

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        good, n = group["good"].to_numpy(bool), group["n"].to_numpy(np.int64)
        kinds = np.array(group["passed"].tolist(), np.int64)
        levels = joint_levels(kinds, n * good, n * ~good, [len(c) for c in cutoffs.values()], risk, error)
        row = {"stratum": group["stratum"].iloc[0]}
        for (rule, cuts), level in zip(cutoffs.items(), levels):
            row[f"cut_{rule}"] = cuts[level - 1] if level else math.inf
        return pd.DataFrame([row])

    schema = "stratum string, " + ", ".join(f"cut_{rule} double" for rule in plan.rules)
    return staged(counts.groupBy("stratum").applyInPandas(choose, schema))


def judged(measured_docs: DataFrame, cutoffs: DataFrame, plan: RiskPlan, stratum: str = "stratum") -> DataFrame:
    """Adds ``base_failed`` and ``kept``. The cutoffs, a row per stratum, are broadcast by Spark only if their file is small."""
    cutoffs = cutoffs.withColumnRenamed("stratum", "_stratum")
    joined = measured_docs.join(cutoffs, measured_docs[stratum].eqNullSafe(cutoffs["_stratum"]), "left")
    rejected = F.lit(False)
    for rule, parts in plan.rules.items():
        rejected = rejected | F.coalesce(_share(F.col("m"), parts) > F.col(f"cut_{rule}"), F.lit(False))
    failed = base_failed(F.col("m"))
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & ~rejected) \
        .drop("_stratum", *[f"cut_{rule}" for rule in plan.rules])


def quality_verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang", plan: RiskPlan | None = None) -> DataFrame:
    """doc_id, the measures, base_failed and kept of every document. Texts are read once; their measures are staged."""
    plan = plan or RiskPlan()
    rows = staged(docs.select("doc_id", F.col(stratum).cast("string").alias("stratum"), measures("text").alias("m")))
    return judged(rows, calibrated(rows, labels, plan), plan).select("doc_id", "m.*", "base_failed", "kept")


def kept_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang", plan: RiskPlan | None = None) -> DataFrame:
    """The documents that pass, with all their columns. The texts are measured twice rather than shuffled once."""
    plan = plan or RiskPlan()
    rows = docs.select("doc_id", F.col(stratum).cast("string").alias("stratum"), measures("text").alias("m"))
    cutoffs = calibrated(staged(rows), labels, plan)
    whole = docs.select(F.struct("*").alias("row"), F.col(stratum).cast("string").alias("stratum"), measures("text").alias("m"))
    return judged(whole, cutoffs, plan).where("kept").select("row.*")
