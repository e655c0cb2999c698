"""Operator 9: toxicity by averaged subword embeddings and a linear softmax, trained jointly.

A word is the bag of itself and its character n-grams, each hashed to a row of one embedding table;
its vector is the average of these rows. A text is the average of the vectors of its different words,
and that average goes through a linear softmax. Misspellings that were never seen share most n-grams
with words that were.

A few toxic words would be lost in a plain average over a long text, so words weigh by the exponent of
a second linear function of their vectors, which is learned with the rest. Training starts from words,
each with the labels of the texts that hold it (words of both classes cancel out, those of toxic texts
alone don't). Then table, weights and softmax are fitted together to whole texts. All of it is numpy,
on a bounded sample of labelled rows; rows set aside calibrate the score. Every text of the corpus is
scored whole, in parallel.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import MIX, mixed, rolling, text_of
from strata.session import stage

TOKEN = re.compile(r"[^\W\d_]+")
SCORED = "doc_id long, score double"
AT_ONCE = 1 << 20  # characters of texts or words that are hashed in one step
REMEMBERED = 400_000  # words whose weights a worker keeps


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled rows per class that are fitted on, at most; one in ``aside`` of them
    calibrates the score. ``seen``: texts in which an n-gram must occur to get an embedding.
    ``doubt``: texts of each class that every word is counted in besides its own. ``sharp``: how much
    the weights of words follow their lean before they are learned. ``epochs`` and ``batch`` of words,
    then of texts."""

    buckets: int = 1 << 17
    width: int = 16
    grams: tuple[int, ...] = (3, 4, 5, 6)
    sample: int = 2_000
    aside: int = 4
    seen: int = 4
    doubt: float = 1.0
    sharp: float = 1.0
    epochs: tuple[int, int] = (3, 3)
    batch: tuple[int, int] = (1_024, 64)
    rate: tuple[float, float] = (0.05, 0.02)
    seed: int = 909


def subwords(words: Sequence[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Bags of all ``words``: the word's number and the bucket of each member. Bucket 0 belongs to every word."""
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = mixed(codes.astype(np.uint64) + np.uint64(1))
    ends = np.cumsum(sizes)
    word = np.repeat(np.arange(len(words)), sizes)
    left = ends[word] - np.arange(len(codes))  # characters from here to the end of the word
    powers = np.cumprod(np.full(int(sizes.max(initial=1)), MIX), dtype=np.uint64)
    whole = np.add.reduceat(codes * powers[left - 1], ends - sizes) if len(words) else codes
    of, hashes = [np.arange(len(words))] * 2, [mixed(whole)]
    for n in settings.grams:
        at = np.flatnonzero(left >= n)
        of.append(word[at])
        hashes.append(mixed(rolling(codes, n)[at] + np.uint64(n)))
    buckets = np.concatenate(hashes) % np.uint64(settings.buckets - 1) + np.uint64(1)
    return np.concatenate(of), np.concatenate([np.zeros(len(words), np.int64), buckets.astype(np.int64)])


def words_in(text: str) -> set[str]:
    """The different words of letters, lower-cased."""
    return set(TOKEN.findall(text.lower()))


def slices(texts: Sequence[str]) -> Iterator[Sequence[str]]:
    """Consecutive texts of about AT_ONCE characters, or one longer text."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > AT_ONCE:
            yield texts[start:i]
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield texts[start:]


@dataclass(frozen=True)
class Model:
    """``toward`` and ``notice``: how far each bucket leans to toxic and adds to the weight of its words;
    only ``known`` ones count. ``slope`` and ``shift`` calibrate."""

    settings: Settings
    toward: np.ndarray
    notice: np.ndarray
    known: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lean and weight of each word."""
        leans, weights = [np.empty(0)], [np.empty(0)]
        for some in slices(words):
            of, bucket = subwords(some, self.settings)
            kept = self.known[bucket]
            of, bucket = of[kept], bucket[kept]
            size = np.bincount(of, minlength=len(some))
            leans.append(np.bincount(of, self.toward[bucket], len(some)) / size)
            weights.append(np.exp(np.clip(np.bincount(of, self.notice[bucket], len(some)) / size, -60, 60)))
        return np.concatenate(leans), np.concatenate(weights)

    def leans(self):
        """A function from texts to logits. Weights and leans of words are kept between calls."""
        number: dict[str, int] = {}
        table = np.empty((2, 0))

        def of_some(texts: Sequence[str]) -> np.ndarray:
            nonlocal table
            if len(number) > REMEMBERED:
                number.clear()
                table = np.empty((2, 0))
            sets = [words_in(t) or {""} for t in texts]
            new = sorted(set().union(*sets).difference(number))
            if new:
                lean, weight = self.words(new)
                number.update(zip(new, range(len(number), len(number) + len(new)), strict=True))
                table = np.concatenate([table, [lean * weight, weight]], axis=1)
            sizes = [len(s) for s in sets]
            found = np.fromiter((number[w] for s in sets for w in sorted(s)), np.int64, sum(sizes))
            lean, weight = np.add.reduceat(table[:, found], np.cumsum([0, *sizes[:-1]]), axis=1)
            return lean / weight + self.bias

        return lambda texts: np.concatenate([np.empty(0), *map(of_some, slices(texts))])

    def scorer(self):
        """A function from texts to scores."""
        leans = self.leans()
        return lambda texts: 1 / (1 + np.exp(-np.clip(self.slope * leans(texts) + self.shift, -40, 40)))


def calibrate(leans: np.ndarray, labels: np.ndarray, rounds: int = 4_000) -> tuple[float, float]:
    """Slope and shift of a logistic curve through scores and labels."""
    if len(set(labels.tolist())) < 2:
        return 1.0, 0.0
    middle, spread = leans.mean(), leans.std() + 1e-9
    x, slope, shift = (leans - middle) / spread, 1.0, 0.0
    for _ in range(rounds):
        wrong = 1 / (1 + np.exp(-(slope * x + shift))) - labels
        slope, shift = slope - 2 * ((wrong * x).mean() + 1e-4 * slope), shift - 2 * wrong.mean()
    return float(slope / spread), float(shift - slope * middle / spread)


class Training:
    """Embedding table, softmax and word weights, and Adam's moments of them."""

    def __init__(self, rng: np.random.Generator, settings: Settings) -> None:
        self.values = {
            "table": rng.normal(0, 0.01, (settings.buckets, settings.width)).astype(np.float32),
            "softmax": rng.normal(0, 0.3, (settings.width, 2)).astype(np.float32),
            "bias": np.zeros(2, np.float32),
            "notice": np.zeros(settings.width, np.float32),
        }
        self.restart()

    def restart(self) -> None:
        self.moments, self.step = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.values.items()}, 0

    def adam(self, name: str, grad: np.ndarray, rate: float, rows=slice(None)) -> None:
        m, v = self.moments[name]
        m[rows] = 0.9 * m[rows] + 0.1 * grad
        v[rows] = 0.999 * v[rows] + 0.001 * grad * grad
        self.values[name][rows] -= rate * (m[rows] / (1 - 0.9**self.step)) / (np.sqrt(v[rows] / (1 - 0.999**self.step)) + 1e-8)

    def fit(self, bags: list[np.ndarray], texts: list[np.ndarray], wanted: np.ndarray, rate: float, weigh: bool) -> None:
        """One step on some texts, each the numbers of its words. ``wanted``: the mass of each class per text."""
        self.step += 1
        table, softmax, notice = (self.values[k] for k in ("table", "softmax", "notice"))
        sizes = np.array([len(t) for t in texts])
        first = np.cumsum([0, *sizes[:-1]])
        text = np.repeat(np.arange(len(texts)), sizes)
        used, word = np.unique(np.concatenate(texts), return_inverse=True)
        members = np.array([len(bags[i]) for i in used])
        ids = np.concatenate([bags[i] for i in used])
        vectors = np.add.reduceat(table[ids], np.cumsum([0, *members[:-1]]), axis=0) / members[:, None]
        pull = (vectors @ notice)[word]
        pull = np.exp(pull - np.maximum.reduceat(pull, first)[text])
        share = (pull / np.add.reduceat(pull, first)[text])[:, None]
        mean = np.add.reduceat(share * vectors[word], first, axis=0)
        logits = mean @ softmax + self.values["bias"]
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        wrong = ((p * wanted.sum(1, keepdims=True) - wanted) / len(texts)).astype(np.float32)
        down = (wrong @ softmax.T)[text]
        back = share * down
        if weigh:
            gain = (vectors[word] * down).sum(1, keepdims=True)
            toward = share * (gain - np.add.reduceat(share * gain, first, axis=0)[text])
            back = back + toward * notice
            self.adam("notice", (toward * vectors[word]).sum(0), rate)
        order = np.argsort(word, kind="stable")
        back = np.add.reduceat(back[order], np.searchsorted(word[order], np.arange(len(used))), axis=0) / members[:, None]
        order = np.argsort(ids, kind="stable")
        begin = np.concatenate([[0], np.flatnonzero(np.diff(ids[order])) + 1])
        grad = np.add.reduceat(back[np.repeat(np.arange(len(used)), members)[order]], begin, axis=0)
        self.adam("table", grad.astype(np.float32), rate, ids[order[begin]])
        self.adam("softmax", mean.T @ wrong, rate)
        self.adam("bias", wrong.sum(0), rate)


def train(texts: list[str], labels: np.ndarray, settings: Settings) -> Model:
    """Joint training with Adam on words, then on texts, each class weighing the same. Without both classes, every score is 0."""
    if len(set(labels.tolist())) < 2:
        nothing = np.zeros(settings.buckets, np.float32)
        return Model(settings, nothing, nothing, nothing == 0, 0.0, 0.0, -40.0)
    rng = np.random.default_rng(settings.seed)
    order = rng.permutation(len(texts))
    aside, used = order[:: settings.aside], np.delete(order, np.s_[:: settings.aside])
    sets = [sorted(words_in(texts[i]) or {""}) for i in used]
    words = sorted(set().union(*sets))
    number = {w: i for i, w in enumerate(words)}
    held = [np.array([number[w] for w in s]) for s in sets]
    times = np.zeros((len(words), 2))
    for numbers, label in zip(held, labels[used], strict=True):
        times[numbers, label] += 1
    of, bucket = (np.concatenate(x) for x in zip(*shifted_bags(words, settings), strict=True))
    known = np.bincount(bucket, times.sum(1)[of], settings.buckets) >= settings.seen
    known[0] = True
    of, bucket = of[known[bucket]], bucket[known[bucket]]
    bucket = bucket[np.argsort(of, kind="stable")]
    bags = np.split(bucket, np.cumsum(np.bincount(of, minlength=len(words)))[:-1])

    per_class = np.maximum(np.bincount(labels[used], minlength=2), 1)
    of_words = (times + settings.doubt) / per_class
    of_words /= max(of_words.sum(1).mean(), 1e-12)
    of_texts = np.eye(2)[labels[used]] * len(used) / (2 * per_class)
    state = Training(rng, settings)
    for part, (examples, wanted) in enumerate([(list(np.arange(len(words))[:, None]), of_words), (held, of_texts)]):
        if part:
            state.restart()
            state.values["notice"][:] = settings.sharp * (state.values["softmax"][:, 1] - state.values["softmax"][:, 0])
        for _ in range(settings.epochs[part]):
            turn = rng.permutation(len(examples))
            for start in range(0, len(turn), settings.batch[part]):
                picked = turn[start : start + settings.batch[part]]
                state.fit(bags, [examples[i] for i in picked], wanted[picked], settings.rate[part], weigh=bool(part))
    table, softmax, bias, notice = (state.values[k] for k in ("table", "softmax", "bias", "notice"))
    model = Model(settings, table @ (softmax[:, 1] - softmax[:, 0]), table @ notice, known, float(bias[1] - bias[0]))
    slope, shift = calibrate(model.leans()([texts[i] for i in aside]), labels[aside])
    return replace(model, slope=slope, shift=shift)


def shifted_bags(words: Sequence[str], settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bags of many words, hashed some at a time, with the words' numbers among all."""
    start = 0
    for some in slices(words):
        of, bucket = subwords(some, settings)
        yield of + start, bucket
        start += len(some)


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on labelled rows whose id is not held out: per class, those with the smallest hashes of the id.

    Repeated labels count once, and an id with several rows takes part with its smallest text, so the
    sample has at most ``settings.sample`` texts of each class and loses none of them.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & ~held_out() & F.col("doc_id").isNotNull())
    known = known.select("doc_id", F.col("toxic").cast("int").alias("toxic"), F.xxhash64(F.lit(settings.seed), "doc_id").alias("h"))
    known = known.distinct()
    picked = None
    for label in (0, 1):
        part = known.filter(F.col("toxic") == label).orderBy("h", "doc_id").limit(settings.sample)
        picked = part if picked is None else picked.union(part)
    picked = F.broadcast(stage(picked.select("doc_id", "toxic"), "toxicity-sample"))  # 2 * sample rows at most
    found = docs.select("doc_id", text_of().alias("text")).join(picked, "doc_id")
    found = found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = found.orderBy("doc_id", "text", "toxic").select("text", "toxic").collect()
    labels = np.array([r.toxic for r in rows], np.int64)
    model = train([r.text for r in rows], labels, settings)
    # The sample holds toxic texts more often than the labelled rows do.
    totals = dict(known.groupBy("toxic").agg(F.count("*")).collect())
    if model.slope and totals.get(0) and totals.get(1):
        odds = totals[1] / totals[0] * (labels == 0).sum() / max(1, labels.sum())
        model = replace(model, shift=model.shift + float(np.log(odds)))
    return model


_scorers: dict[int, tuple[Model, object]] = {}


def scorer_of(model: Model):
    """The scorer of a model, kept with the words that it knows for the next task of this worker."""
    if id(model) not in _scorers:
        _scorers.clear()
        _scorers[id(model)] = (model, model.scorer())
    return _scorers[id(model)][1]


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of ``docs`` (doc_id, text), texts whole.

    Null and empty texts, and texts without letters, get the score of an empty word; repeated rows get
    equal scores; a table without rows gives none. Other columns are not read. Labels of other values
    than 0 and 1 are not used in fitting.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer_of(shared.value)
        for batch in batches:
            values = score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(values, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(scored, SCORED)


def op9(spark, sf_dir: str) -> DataFrame:
    """The query: toxicity of all documents, learned from the rows that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    scores = score_toxicity(docs, model)
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
