"""Operator 12: runs of repeated words, found by longest common extensions on a difference cover.

A run is a stretch of words that repeats with smallest period ``q`` over at least four periods (and
six words) and can't be extended on either side. Any such run of period ``q`` holds a multiple of ``3 q``
at which the words ``q`` apart agree, so looking at the harmonic grid ``i = 0, 3 q, 6 q, ...`` of all periods, about
``n ln(n) / 3`` places of an ``n``-word text, finds every run. From a place, the run extends as far as the
common extension of the suffixes at ``i`` and ``i + q`` to the right and of the prefixes to the left.

Common extensions come from a difference cover: residues modulo ``V`` such that any two places reach covered
ones after the same few words. Only suffixes at covered places are sorted (a fifth of all); two
suffixes are compared word by word until both are synchronised with the cover, and a sparse table of
range minima over the sorted samples gives the rest. Texts of many documents are handled together,
ended by words that occur once, so that no extension leaves its document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_of

#: A perfect difference set: every residue modulo V is a difference of two of them.
V, COVER = 31, (1, 5, 11, 24, 25, 27)
MIN_WORDS, MIN_POWER = 6, 4
#: Words and grid places that one round of array work holds at most, apart from a longer single text.
ROUND_WORDS, ROUND_PLACES = 1 << 20, 1 << 22

RESULT = pa.schema(
    [
        ("doc_id", pa.string()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
        ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
        ("collapsed_sha256", pa.string()),
    ]
)


def _shifts() -> np.ndarray:
    """[a, b]: the smallest step that takes residues a and b both into the cover."""
    covered = np.isin(np.arange(V), COVER)
    steps = np.full((V, V), -1)
    for step in reversed(range(V)):
        both = np.outer(np.roll(covered, -step), np.roll(covered, -step))
        steps[both] = step
    return steps


SHIFTS = _shifts()


class Extensions:
    """Longest common extensions of suffixes of ``ids``, whose last word must occur nowhere else."""

    def __init__(self, ids: np.ndarray):
        self.n = len(ids)
        self.words = np.concatenate([ids.astype(np.int64), np.full(V, -1)])
        place = np.arange(self.n)
        sampled = np.isin(place % V, COVER)
        self.at = place[sampled]
        self.sample = np.cumsum(sampled) - 1
        levels = self._sorted_samples()
        self._range_minima(*levels)

    def _sorted_samples(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Ranks of the sampled suffixes by their first V, 2 V, 4 V, ... words, until all differ."""
        rank = np.zeros(len(self.at), np.int64)
        alphabet = int(self.words.max()) + 2
        # As many words as fit behind a rank into 63 bits are compared by one sort.
        at_once = max(1, (63 - len(rank).bit_length()) // alphabet.bit_length())
        for done in range(0, V, at_once):
            key = rank
            for k in range(done, min(V, done + at_once)):
                key = key * alphabet + self.words[self.at + k] + 1
            rank = np.unique(key, return_inverse=True)[1]
            if rank.max(initial=0) + 1 == len(rank):
                break
        levels, step = [rank], len(COVER)
        while rank.max(initial=0) + 1 < len(rank):
            later = np.full(len(rank), -1)
            later[: max(0, len(rank) - step)] = rank[step:]
            rank = np.unique(rank * (len(rank) + 1) + later + 1, return_inverse=True)[1]
            levels.append(rank)
            step *= 2
        self.rank = rank
        order = np.empty(len(rank), np.int64)
        order[rank] = np.arange(len(rank))
        return levels, order

    def _range_minima(self, levels: list[np.ndarray], order: np.ndarray) -> None:
        """Common prefixes of neighbours in the sorted order, and a sparse table of their minima."""
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        top = len(self.rank)
        # Where ranks of one level agree, so do V * 2 ** level words. The last level tells all apart.
        for level in reversed(range(len(levels) - 1)):
            reach = (a < top) & (b < top)
            same = reach & (levels[level][np.minimum(a, top - 1)] == levels[level][np.minimum(b, top - 1)])
            skip = len(COVER) << level
            a[same] += skip
            b[same] += skip
            common[same] += V << level
        left = np.nonzero((a < top) & (b < top))[0]
        x, y = self.at[a[left]], self.at[b[left]]
        for _ in range(V):
            same = self.words[x] == self.words[y]
            left, x, y = left[same], x[same] + 1, y[same] + 1
            common[left] += 1
            inside = np.maximum(x, y) < self.n
            left, x, y = left[inside], x[inside], y[inside]
            if not len(left):
                break
        self.minima = [common]
        width = 1
        while 2 * width <= len(common):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words the suffixes at ``i`` and ``j`` (i != j everywhere) have in common."""
        steps = SHIFTS[i % V, j % V]
        common = np.zeros(len(i), np.int64)
        open_ = np.arange(len(i))
        for k in range(V):
            done = steps[open_] == k
            here = open_[done]
            if len(here):
                common[here] = k + self._of_samples(i[here] + k, j[here] + k)
            open_ = open_[~done]
            same = self.words[i[open_] + k] == self.words[j[open_] + k]
            common[open_[~same]] = k
            open_ = open_[same]
            if not len(open_):
                break
        return common

    def _of_samples(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[self.sample[i]], self.rank[self.sample[j]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        k = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(i), np.int64)
        for level in np.unique(k):
            here = k == level
            row = self.minima[level]
            found[here] = np.minimum(row[low[here]], row[high[here] - (1 << level)])
        return found


def grid(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of the harmonic grids of texts of these sizes, in rounds of bounded size."""
    periods = sizes // MIN_POWER
    periods[sizes < MIN_WORDS] = 0
    text = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    places = (sizes[text] - period - 1) // (3 * period) + 1
    upto = np.cumsum(places)
    start = 0
    while start < len(text):
        done = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, done + ROUND_PLACES, side="right")))
        count = places[start:end]
        number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        q = np.repeat(period[start:end], count)
        yield np.repeat(text[start:end], count), number * 3 * q, q
        start = end


def find_runs(texts: Sequence[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, given as arrays of word numbers from 0, by start and period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    if not sizes.sum():
        return found
    joined, first = _joined(texts, sizes)
    # Most places differ at once; only texts with a place that does not are indexed.
    seeds = [np.empty((3, 0), np.int64)]
    for text, place, q in grid(sizes):
        at = first[text] + place
        same = joined[at] == joined[at + q]
        seeds.append(np.stack([text[same], place[same], q[same]]))
    text, place, q = np.concatenate(seeds, axis=1)
    text, place, q = _plausible(joined, first, sizes, text, place, q)
    if not len(text):
        return found
    wanted = np.unique(text)
    number = np.zeros(len(sizes), np.int64)
    number[wanted] = np.arange(len(wanted))
    part_sizes = sizes[wanted]
    part, part_first = _joined([texts[t] for t in wanted], part_sizes)
    at = part_first[number[text]] + place
    right = Extensions(part).of(at, at + q)
    # Mirrored, with the ends of texts in front of them, and one more word that occurs once behind.
    mirror = np.concatenate([part[:-1][::-1], [part.max() + 1]])
    back = len(part) - 2 - at
    # The common extension to the left of the places before i and i + q.
    inside = place > 0
    left = np.zeros(len(at), np.int64)
    if inside.any():
        left[inside] = Extensions(mirror).of(back[inside] + 1, (back - q)[inside] + 1)
    length = left + right + q
    good = length >= np.maximum(MIN_WORDS, MIN_POWER * q)
    text, start, length, q = text[good], (place - left)[good], length[good], q[good]
    # One stretch with several periods has the smallest; the others are its multiples.
    order = np.lexsort((q, length, start, text))
    rows = np.stack([text, start, length, q], axis=1)[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    for t, *run in rows[fresh].tolist():
        found[t].append(tuple(run))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def _joined(texts: Sequence[np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each followed by a word that occurs once, and where each begins."""
    first = np.cumsum(sizes + 1) - sizes - 1
    top = max((int(t.max()) for t in texts if len(t)), default=0) + 1
    joined = np.empty(int((sizes + 1).sum()), np.int64)
    for at, words in zip(first, texts, strict=True):
        joined[at : at + len(words)] = words
    joined[first + sizes] = top + np.arange(len(texts))
    return joined, first


def _plausible(joined, first, sizes, text, place, q):
    """The seeds whose extension to either side passes a few words, or whose short run is long enough already."""
    at = first[text] + place
    need = np.maximum(MIN_WORDS, MIN_POWER * q) - q
    short = np.minimum(need, V)
    reach = np.zeros(len(at), np.int64)
    for towards in (1, -1):
        live = np.arange(len(at))
        for k in range(V):
            x = at[live] + towards * k - (towards < 0)
            inside = (x >= first[text[live]]) & (x + q[live] < first[text[live]] + sizes[text[live]])
            live = live[inside]
            x = x[inside]
            live = live[joined[x] == joined[x + q[live]]]
            if not len(live):
                break
            reach[live] += 1
    keep = reach >= short
    return text[keep], place[keep], q[keep]


def altered(words: list[bytes], doc_id: str | None) -> list[bytes]:
    """The text whose runs are looked for: for a tenth of the ids, the words repeat from some place on."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = crc32(doc_id.encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(n - a) // len(unit))))[: n - a]


def digest(words: list[bytes], runs: Sequence[tuple[int, int, int]]) -> tuple:
    """The result of one text, without its id."""
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    kept = words
    if runs:
        edges = np.zeros(len(words) + 1, np.int64)
        for s, length, q in runs:
            edges[s + q] += 1
            edges[s + length] -= 1
        kept = [words[i] for i in np.nonzero(np.cumsum(edges[:-1]) == 0)[0]]
    return (len(runs), *best, sha256(listed.encode()).hexdigest(), sha256(b" ".join(kept)).hexdigest())


def _scan(change: Callable) -> Callable:
    def rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            held, size = [], 0
            for i in range(len(batch)):
                words = (texts[i].as_py() or "").encode().split()
                doc_id = ids[i].as_py()
                held.append((doc_id, change(words, doc_id)))
                size += len(words)
                if size >= ROUND_WORDS or i == len(batch) - 1:
                    yield _round(held)
                    held, size = [], 0

    return rounds


def _round(held: list[tuple[str | None, list[bytes]]]) -> pa.RecordBatch:
    numbers: dict[bytes, int] = {}
    ids = [
        np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)) for _, words in held
    ]
    runs = find_runs(ids)
    rows = [(doc_id, *digest(words, found)) for (doc_id, words), found in zip(held, runs, strict=True)]
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, RESULT, strict=True)], schema=RESULT)


def periodic_runs(docs: DataFrame, change: Callable[[list[bytes], str | None], list[bytes]] = lambda words, _: words) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its runs, the longest of them, and the text without repeats.

    A word goes from the collapsed text if a run holds it after the run's first period. ``change`` may alter
    the words before. Null and empty texts have no words and no runs, and a null doc_id is returned as
    null. Repeated rows give repeated results; an empty table gives none. Other columns are not
    read, so their names can't clash. A text of any length is one piece of work, in memory
    proportional to its words; many short texts are handled together.
    """
    kind = docs.schema["doc_id"].dataType
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_of().alias("text"))
    types = {pa.string(): "string", pa.int64(): "bigint"}
    found = rows.mapInArrow(_scan(change), ", ".join(f"{f.name} {types[f.type]}" for f in RESULT))
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def op12(spark, sf_dir: str) -> DataFrame:
    """The query: runs of all documents, a tenth of which are made periodic from some word on."""
    return periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), altered)
