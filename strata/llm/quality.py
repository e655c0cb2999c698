"""Operator 5: quality rules as weak supervision.

Each rule looks at one property of a text and votes good, bad or abstains. Nobody says how reliable
a rule is: expectation-maximisation estimates how often each one is right on good and on bad texts,
from how often the rules agree over the whole corpus, and every document gets the posterior
probability of being good.

Votes are the digits of one number, so the corpus is summed up in at most ``3 ** rules`` counts; only
these come to the driver. The posterior is then a sum of logarithms in a plain expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import columns_of, rolling, text_of, whole_row, word_hashes
from strata.session import stage

#: Frequent short words of the corpus languages (fixed values).
STOP_WORDS = frozenset(
    b"the of and to in is that for it was on are as with be der die und das den von zu mit ist ein eine "
    b"le la les de des et un une que qui en dans du est pour pas el los las una y por con para se del".split()
)
FEATURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, "
    "n_letters long, n_upper long, n_stop long, n_marked long, pattern long"
)
_SYMBOL, _UPPER, _LETTER, _BLANK = (np.zeros(256, bool) for _ in range(4))
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = True
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Ends of ordinary words: letters, digits, bytes beyond ASCII and common punctuation.
_PLAIN = np.zeros(256, bool)
_PLAIN[48:58] = _PLAIN[128:] = True
_PLAIN |= _LETTER
_PLAIN[list(b".,;:?!'\")")] = True


def repeated(hashes: np.ndarray, width: int) -> int:
    """Words in runs of ``width`` that occur twice or more in the text."""
    runs = rolling(hashes, width)
    if len(runs) < 2:
        return 0
    order = np.argsort(runs, kind="stable")
    same = np.diff(runs[order]) == 0
    if not same.any():
        return 0
    often = np.zeros(len(runs), bool)
    often[order[:-1][same]] = often[order[1:][same]] = True
    hit = np.zeros(len(hashes), bool)
    for j in range(width):
        hit[j : j + len(often)] |= often
    return int(hit.sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The features of one text without the votes."""
    raw, words = np.frombuffer(text, np.uint8), text.split()
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\r\x0b\x0c")]
    counts = np.bincount(raw, minlength=256)
    characters = counts.sum() - counts[0x80:0xC0].sum()
    ends = np.fromiter((w[-1] for w in words), np.uint8, len(words))
    lowered = text.lower().split()
    return (
        len(words), int(characters - counts[_BLANK].sum()), int(counts[_SYMBOL].sum()), len(lines) - len(set(lines)),
        repeated(word_hashes(words, len(words)), 3), len(lines), int(counts[_LETTER].sum()), int(counts[_UPPER].sum()),
        sum(map(STOP_WORDS.__contains__, lowered)), int((~_PLAIN[ends]).sum()) if words else 0,
    )


def share(part: pd.Series, whole: pd.Series) -> pd.Series:
    return part / whole.clip(lower=1)


#: name: (feature, bad votes, good votes). A text that neither test takes gets no vote.
RULES = {
    "length": (lambda f: f.n_words, lambda x: x < 20, lambda x: x >= 100),
    "symbols": (lambda f: share(f.n_symbols, f.n_words), lambda x: x > 0.2, lambda x: x < 0.03),
    "repeated lines": (lambda f: share(f.n_dup_lines, f.n_lines), lambda x: x > 0.3, lambda x: x < 0.05),
    "repeated words": (lambda f: share(f.n_repeat_words, f.n_words), lambda x: x > 0.4, lambda x: x < 0.15),
    "word length": (lambda f: share(f.word_chars, f.n_words), lambda x: (x < 2.5) | (x > 14), lambda x: (x > 3.2) & (x < 9)),
    "capitals": (lambda f: share(f.n_upper, f.n_letters), lambda x: x > 0.5, lambda x: x < 0.15),
    "stop words": (lambda f: share(f.n_stop, f.n_words), lambda x: x < 0.02, lambda x: x > 0.08),
    "marked words": (lambda f: share(f.n_marked, f.n_words), lambda x: x > 0.3, lambda x: x < 0.05),
}


def votes(features: pd.DataFrame) -> pd.Series:
    """The votes as digits to base 3: 0 none, 1 bad, 2 good."""
    pattern = pd.Series(0, features.index, dtype="int64")
    for j, (value, bad, good) in enumerate(RULES.values()):
        x = value(features)
        pattern += 3**j * np.select([bad(x), good(x)], [1, 2], 0)
    return pattern


def features_of(text: Column) -> Column:
    """A struct of FEATURES. Not marked deterministic, so that it is evaluated once for each row."""

    @F.pandas_udf(FEATURES)
    def measured(texts: pd.Series) -> pd.DataFrame:
        names = [c.split()[0] for c in FEATURES.split(", ")]
        found = pd.DataFrame([measure(x) for x in texts], columns=names[:-1], dtype="int64")
        return found.assign(pattern=votes(found))

    return measured.asNondeterministic()(text.cast("binary"))


@dataclass(frozen=True)
class Model:
    """Share of good texts, and for each rule how often its vote is right on good and on bad texts."""

    good: float
    right_on_good: np.ndarray
    right_on_bad: np.ndarray

    def posterior(self, pattern: Column) -> Column:
        logit = F.lit(float(np.log(self.good / (1 - self.good))))
        for j, (g, b) in enumerate(zip(self.right_on_good, self.right_on_bad, strict=True)):
            digit = F.floor(pattern / 3**j) % 3
            logit = logit + F.when(digit == 2, float(np.log(g / (1 - b)))).when(digit == 1, float(np.log((1 - g) / b))).otherwise(0.0)
        return 1 / (1 + F.exp(-logit))


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> Model:
    """Expectation-maximisation over vote patterns and their counts.

    It starts from the majority of votes. Rules are taken to be better than chance, which settles
    which of the two classes is the good one; counts are smoothed by one right and one wrong vote.
    Without rows, all rules are right in three of four cases and half of the texts are good.
    """
    rules = len(RULES)
    if not len(patterns):
        return Model(0.5, np.full(rules, 0.75), np.full(rules, 0.75))
    digits = patterns[:, None] // 3 ** np.arange(rules) % 3
    up, down, n = digits == 2, digits == 1, counts.astype(float)
    score = up.sum(1) - down.sum(1)
    p = 1 / (1 + np.exp(-score.astype(float)))
    for _ in range(rounds):
        g, b = (n * p)[:, None], (n * (1 - p))[:, None]
        ups, downs = (g * up).sum(0), (g * down).sum(0)
        on_good = np.clip((ups + 1) / (ups + downs + 2), 0.51, 0.999)
        ups, downs = (b * up).sum(0), (b * down).sum(0)
        on_bad = np.clip((downs + 1) / (ups + downs + 2), 0.51, 0.999)
        good = float(np.clip((n * p).sum() / n.sum(), 0.01, 0.99))
        logit = np.log(good / (1 - good)) + up @ np.log(on_good / (1 - on_bad)) + down @ np.log((1 - on_good) / on_bad)
        fresh = 1 / (1 + np.exp(-logit))
        if np.abs(fresh - p).max() < 1e-9:
            break
        p = fresh
    return Model(good, on_good, on_bad)


def learn(measured: DataFrame) -> Model:
    """The model of a frame with a ``pattern`` column; what is collected is bounded by the patterns."""
    found = measured.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()
    return fit(np.array([r.pattern for r in found], np.int64), np.array([r.n for r in found], np.int64))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def score_quality(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the features, base_failed, posterior and kept.

    Null and empty texts have no words, so they fail; repeated rows get equal verdicts. Texts are
    read whole. Other columns are ignored.
    """
    measured = docs.select("doc_id", features_of(text_of()).alias("f")).select("doc_id", "f.*")
    measured = stage(measured, "quality-features")
    posterior = learn(measured).posterior(F.col("pattern"))
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & (posterior >= threshold)).alias("kept"), posterior.alias("posterior"),
    )


def good_documents(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that are kept. Texts are measured twice instead of shuffled."""
    model = learn(docs.select(features_of(text_of()).alias("f")).select("f.pattern"))
    seen = docs.select(whole_row(docs), features_of(text_of()).alias("f")).select("_row", "f.*")
    kept = seen.filter(~base_failed() & (model.posterior(F.col("pattern")) >= threshold))
    return kept.select(*columns_of(docs))


def op5(spark, sf_dir: str) -> DataFrame:
    """The query: features and verdict of all documents."""
    return score_quality(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
