"""Risk-controlled quality rules.

Every rule compares a share of the text with a cutoff. Cutoffs are not set by hand: per stratum
(language), the labelled clean texts (quality 1) that pass the base rules are a holdout, and all rules
together take the strictest step for which the exact binomial (Clopper-Pearson) bound shows that they
reject at most ``MAX_FALSE_REJECTION`` of clean texts. A step is a cutoff of ``GRID`` for every rule, but
no rule goes below its floor: the strictest cutoff that rejects few clean texts (``FLOOR_REJECTION``) of
the other strata. Floors come from other texts than those tested, so the steps of a stratum are fixed
before its test; they are tried from lenient to strict, and the first failure ends the search (a fixed
sequence needs no correction). The error level is shared by the strata (Bonferroni). So with probability
0.95 no stratum loses more than 5 % of its clean texts to all rules together. A stratum with too few
labels (for four strata under 86) gets no cutoff, and its rules reject nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.tables import map_arrow, ship, written
from tidelake.llm.textkit import BREAK, U64, Words, mix, slices, windows

MAX_FALSE_REJECTION = 0.05
ERROR_LEVEL = 0.05
#: Share of the other strata's clean texts that a rule may reject at its floor.
FLOOR_REJECTION = 0.005
GRID = (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.075, 0.05, 0.03, 0.02, 0.01)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_calls")
#: Rules as (numerator, denominator); the share rejects from the cutoff on.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "shouting": ("n_capitals", "word_chars"),
    "calls": ("n_calls", "word_chars"),
}

_codes = np.arange(256)
SYMBOL = np.isin(_codes, np.frombuffer(b"#*$%&|<>", np.uint8))
CAPITAL = (_codes >= 0x41) & (_codes <= 0x5A)
CALL = np.isin(_codes, np.frombuffer(b"!?", np.uint8))
#: Bytes that begin a code point of a word.
POINT = ~BREAK & ((_codes & 0xC0) != 0x80)


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside three-word windows that occur at least twice."""
    grams = windows(hashes, 3)
    if len(grams) < 2:
        return 0
    ordered = np.argsort(grams)
    same = grams[ordered[1:]] == grams[ordered[:-1]]
    if not same.any():
        return 0
    covered = np.zeros(len(hashes), dtype=bool)
    for at in (ordered[1:][same], ordered[:-1][same]):
        for k in range(3):
            covered[at + k] = True
    return int(covered.sum())


def counts_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The columns ``COUNTS`` of a slice of texts."""
    words = Words(data, offsets)
    hashes, bounds = words.hashes(), words.bounds
    out = np.zeros((len(COUNTS), len(offsets) - 1), dtype=np.int64)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flags[data])))[offsets])

    out[0] = np.diff(bounds)
    out[1], out[2], out[6], out[7] = per_text(POINT), per_text(SYMBOL), per_text(CAPITAL), per_text(CALL)
    # Lines are spans between newlines; equal spans of bytes have equal hashes.
    cuts = np.flatnonzero(data == 0x0A)
    begins = np.sort(np.concatenate((offsets[:-1], cuts + 1)))
    ends = np.sort(np.concatenate((offsets[1:], cuts)))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(cuts, offsets)) + 1)
    span = Words.__new__(Words)
    span.data, span.starts, span.ends = data, begins, ends
    lines = span.hashes()
    worded = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, begins)
    lines, text = lines[worded], text[worded]
    out[5] = np.bincount(text, minlength=len(offsets) - 1)
    _, firsts = np.unique(mix(lines ^ mix(text.astype(U64))), return_index=True)
    out[3] = out[5] - np.bincount(text[firsts], minlength=len(offsets) - 1)
    for row in range(len(offsets) - 1):
        out[4, row] = repeated_words(hashes[bounds[row] : bounds[row + 1]])
    return out


def counter(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [counts_of(data, offsets) for _, _, data, offsets in slices(batch.column("text"))]
            counts = np.concatenate(parts, axis=1) if parts else np.zeros((len(COUNTS), 0), dtype=np.int64)
            kept = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, counts)], names=[*names, *COUNTS])

    return run


def with_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` and the counts, which take the place of columns of their names."""
    keep = [c for c in keep if c not in COUNTS]
    schema = T.StructType([*(docs.schema[c] for c in keep), *(T.StructField(c, T.LongType()) for c in COUNTS)])
    read = list(dict.fromkeys([*keep, "text"]))
    return map_arrow(docs.select(*read), counter(keep), schema)


BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def chance_at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial count."""
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    most = max(logs)
    return min(1.0, math.exp(most) * math.fsum(math.exp(x - most) for x in logs))


def share(rule: str):
    top, bottom = RULES[rule]
    return F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double")), F.lit(0.0))


def strictest(level: float, allowed: float):
    """Of one stratum: the strictest step whose upper bound of false rejection is allowed."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        best, n = None, int(pdf["n"].iloc[0])
        rejected = dict(zip(pdf["cutoff"], pdf["rejected"], strict=True))
        for cutoff in GRID:
            k = int(rejected[cutoff])
            # The Clopper-Pearson bound is at most `allowed` just if so few rejections were this unlikely.
            if k > allowed * n or chance_at_most(k, n, allowed) > level:
                break
            best = cutoff
        return pdf.iloc[:1][["stratum"]].assign(step=best)

    return run


def floors(holdout: DataFrame) -> DataFrame:
    """(stratum, floor_<rule>...): the strictest cutoff of each rule by the clean texts of the other strata.

    NULL if even the most lenient cutoff rejects too many of them; the strictest where there are no others.
    """
    sums = [F.sum((share(rule) >= cutoff).cast("long")).alias(f"{rule} {i}") for rule in RULES for i, cutoff in enumerate(GRID)]
    wide = written(holdout.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *sums))
    total = wide.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in wide.columns[1:])).first()

    def floor(rule: str):
        allowed = FLOOR_REJECTION * (F.lit(total["n"]) - F.col("n"))
        few = [F.when(F.lit(total[f"{rule} {i}"]) - F.col(f"{rule} {i}") <= allowed, F.lit(cutoff)) for i, cutoff in enumerate(GRID)]
        return F.least(*few).alias(f"floor_{rule}")

    return written(wide.select("stratum", *map(floor, RULES)))


def cutoffs(counts: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """One row per stratum that has labels, with a column cut_<rule> each (NULL: no cutoff).

    Of a doc_id whose labels disagree none counts; labels of quality other than 1 are not clean.
    """
    clean = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("q"), F.max("quality").alias("p")).where("q = 1 AND p = 1")
    holdout = counts.where(f"NOT ({BASE_FAILED})").join(clean, F.col("doc_id") == F.col("_id"))
    holdout = written(holdout.select(F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), *COUNTS))
    limits = floors(holdout)

    def rejects(cutoff: float):
        out = F.lit(False)
        for rule in RULES:
            out = out | F.coalesce((share(rule) >= cutoff) & (share(rule) >= F.col(f"floor_{rule}")), F.lit(False))
        return out

    steps = [F.sum(rejects(cutoff).cast("long")).alias(f"step {i}") for i, cutoff in enumerate(GRID)]
    wide = written(holdout.join(limits, "stratum").groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *steps))
    tested = F.array(*(F.struct(F.lit(c).alias("cutoff"), F.col(f"step {i}").alias("rejected")) for i, c in enumerate(GRID)))
    tests = wide.select("stratum", "n", F.explode(tested).alias("t")).select("stratum", "n", "t.*")
    level = ERROR_LEVEL / max(1, wide.count())
    ship(tests.sparkSession)
    found = tests.groupBy("stratum").applyInPandas(strictest(level, MAX_FALSE_REJECTION), "stratum string, step double")
    cuts = (F.when(F.col("step").isNotNull() & F.col(f"floor_{r}").isNotNull(), F.greatest("step", f"floor_{r}")).alias(f"cut_{r}") for r in RULES)
    return found.join(limits, "stratum").select("stratum", *cuts)


def judge(docs: DataFrame, labels: DataFrame, keep: list[str], stratum: str = "lang") -> DataFrame:
    """Columns ``keep`` of ``docs``, the counts, base_failed, and kept (false: a base rule or a cutoff rejects it).

    A text that is NULL or empty has no words and fails the base rules. Rows that repeat are judged each.
    Columns of the names of outputs give way; a NULL stratum is a stratum of its own.
    """
    counts = written(with_counts(docs, ["doc_id", stratum]))
    limits = written(cutoffs(counts, labels, stratum))
    keep = [c for c in keep if c not in (*COUNTS, "base_failed", "kept", "stratum")]
    held = [*keep, *([stratum] if stratum not in keep else [])]
    rows = with_counts(docs, held).withColumn("stratum", F.coalesce(F.col(stratum).cast("string"), F.lit("")))
    rejects = F.lit(False)
    for rule in RULES:
        rejects = rejects | F.coalesce(share(rule) >= F.col(f"cut_{rule}"), F.lit(False))
    judged = rows.join(limits, "stratum", "left").withColumn("base_failed", F.expr(BASE_FAILED))
    return judged.withColumn("kept", ~F.col("base_failed") & ~rejects).select(*keep, *COUNTS, "base_failed", "kept")


def kept_only(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``."""
    names = docs.columns
    inner = docs.toDF(*(f"{c}_" if c in (*COUNTS, "base_failed", "kept", "stratum") else c for c in names))
    return judge(inner, labels, inner.columns).where("kept").select(*inner.columns).toDF(*names)
