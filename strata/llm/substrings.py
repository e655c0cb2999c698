"""Operator 8: removal of repeated passages with a compressed FM-index per shard.

A window is a run of ``width`` words; a word goes if a window that covers it occurs anywhere else.

Streaming all documents through the index of every shard would cost the square of the corpus.
So passages are routed by content: each window belongs to the rarest-looking (smallest hash) of its
short word grams, its anchor. Equal windows have equal anchors; neighbouring windows mostly share one
and travel together as a segment. An anchor that occurs once holds no repeat. Of the others, one
representative of each different segment goes to the shard of the anchor, weighted by how often the
segment occurs. Each shard builds an FM-index of its passages and streams them through it: backward
search gives for every end position the length of the longest match that occurs twice or more, up to
``width``; windows that reach it are reported for all occurrences of their segment.

Shards have a fixed size and their number grows with the input. An anchor whose passages overflow a
shard is split by a further gram: its windows are routed by their two smallest grams, then by three,
and so on, until every part fits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import MIX, bounded_broadcast, forget, mixed, rolling, text_of, word_hashes
from strata.session import stage

GRAM = 8
SHARD_WORDS = 1 << 18
#: A key with more than one in so many rows is dealt over parts in joins, so there are at most 1,000 such keys.
HEAVY = 1_000
_BACK = np.uint64(pow(int(MIX), -1, 1 << 64))


def spans_hash(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the words in each span."""
    n = len(hashes)
    forth = np.cumprod(np.full(n + 1, MIX, np.uint64))
    back = np.cumprod(np.full(n + 1, _BACK, np.uint64))
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * forth[:n])])
    return mixed((upto[end] - upto[start]) * back[start] + (end - start).astype(np.uint64))


def segments(hashes: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """anchor, hash, first window and number of windows of each run of windows with one anchor."""
    windows = len(hashes) - width + 1
    if windows <= 0:
        return (np.empty(0, np.int64),) * 4
    grams = rolling(hashes, GRAM)
    at = np.lib.stride_tricks.sliding_window_view(grams, width - GRAM + 1).argmin(1) + np.arange(windows)
    start = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    end = np.append(start[1:], windows)
    return grams[at[start]].view(np.int64), spans_hash(hashes, start, end + width - 1).view(np.int64), start, end - start


SEGMENTS = "key long, anchor long, seg long, start int, n int"


def find_segments(width: int):
    """Maps batches of key, text (bytes) to SEGMENTS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, row = [], []
            for i, text in enumerate(batch.column("text")):
                words = text.as_py().split()
                if len(words) >= width:
                    found.append(segments(word_hashes(words, len(words)), width))
                    row.append(np.full(len(found[-1][0]), i))
            if found:
                anchor, seg, start, n = (np.concatenate(x) for x in zip(*found, strict=True))
                keys = batch.column("key").take(pa.array(np.concatenate(row)))
                columns = [keys, pa.array(anchor), pa.array(seg), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "anchor", "seg", "start", "n"])

    return run


class FMIndex:
    """An FM-index over small integers, 0 being a separator, for patterns of up to ``depth`` symbols.

    ``weights`` says how often each position occurs in the corpus. Suffixes are sorted by their first ``depth`` symbols, which is all that such patterns need. The
    last column of the sorted rotations is kept in a wavelet matrix: one packed bit plane per bit of
    the alphabet with counts for each 64 bits.
    """

    def __init__(self, tokens: np.ndarray, weights: np.ndarray, depth: int):
        n = len(tokens)
        rank, step = tokens.astype(np.int64), 1
        self.often = np.ones(n, bool)
        while step < depth:
            after = np.zeros(n, np.int64)
            after[:-step] = rank[step:] + 1
            key = rank * (n + 2) + after
            order = np.argsort(key, kind="stable")
            fresh = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            step *= 2
            if step == GRAM:  # grams that occur once can be in no repeated window
                self.often = np.bincount(rank, weights)[rank] > 1
        self.upto = np.concatenate([[0], np.cumsum(weights[order])])
        last = tokens[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(tokens, minlength=int(tokens.max()) + 1))])
        self.levels = max(1, int(tokens.max()).bit_length())
        self.planes, self.counts, self.zeros = [], [], []
        column = last.astype(np.int64)
        for level in reversed(range(self.levels)):
            bits = ((column >> level) & 1).astype(bool)
            plane = np.zeros((n // 64 + 1) * 64, np.uint8)
            plane[:n] = bits
            packed = np.packbits(plane, bitorder="little").view(np.uint64)
            self.planes.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed).astype(np.int32))]))
            self.zeros.append(int(n - bits.sum()))
            column = np.concatenate([column[~bits], column[bits]])
        symbols = np.arange(len(self.first) - 1)
        self.base = self.descend(symbols, np.zeros(len(symbols), np.int64))
        self.size = n

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Follow each symbol's bits down the wavelet matrix from position ``at``."""
        for k, level in enumerate(reversed(range(self.levels))):
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[k][word] + np.bitwise_count(self.planes[k][word] & below)
            at = np.where((symbol >> level) & 1, self.zeros[k] + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search for many intervals at once."""
        start = self.first[symbol] - self.base[symbol]
        return start + self.descend(symbol, low), start + self.descend(symbol, high)

    def matches(self, tokens: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
        """Matching statistics: for each end in ``tokens``, symbols up to it whose weights sum to two or more, at most ``most``."""
        length = np.zeros(len(ends), np.int64)
        lane = np.arange(len(ends))
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.size)
        for step in range(most):
            low, high = self.extend(tokens[ends[lane] - step], low, high)
            alive = self.upto[high] - self.upto[low] >= 2
            lane, low, high = lane[alive], low[alive], high[alive]
            length[lane] += 1
            if not len(lane):
                break
        return length


PASSAGES = "route long, anchor long, seg long, offset int, n int, weight int, words array<long>"
HITS = "anchor long, seg long, offset int, n int"


def runs(row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of consecutive ``at`` within one ``row``."""
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(row) != 0)) + 1
    first = np.concatenate([[0], cut]) if len(at) else cut
    return first, np.diff(np.append(first, len(at)))


def shard_repeats(width: int):
    """Maps the PASSAGES of one shard to HITS: their windows that the corpus holds twice or more."""

    def run(shard: pa.Table) -> pa.Table:
        anchor, seg, offset, n, weight = (shard.column(c).to_numpy() for c in ("anchor", "seg", "offset", "n", "weight"))
        # Repeated rows send their passages more than once.
        order = np.lexsort((offset, seg, anchor))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (np.diff(anchor[order]) != 0) | (np.diff(seg[order]) != 0) | (np.diff(offset[order]) != 0)
        order = order[fresh]
        anchor, seg, offset, n, weight = (x[order] for x in (anchor, seg, offset, n, weight))
        words = shard.column("words").combine_chunks().take(pa.array(order))
        begin = np.concatenate([[0], np.cumsum(n + width)])
        tokens = np.zeros(begin[-1], np.int64)
        place = np.ones(begin[-1], bool)
        place[begin[1:] - 1] = False
        tokens[place] = np.unique(words.flatten().to_numpy(), return_inverse=True)[1] + 1
        index = FMIndex(tokens, np.repeat(weight, n + width), width + 1)
        row = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        rare = np.concatenate([[0], np.cumsum(~index.often)])
        first = begin[row] + at
        hopeful = rare[first + width - GRAM + 1] == rare[first]
        row, at, first = row[hopeful], at[hopeful], first[hopeful]
        hit = index.matches(tokens, first + width - 1, width) >= width
        row, at = row[hit], at[hit]
        first, length = runs(row, at)
        row, at = row[first], at[first]
        columns = [anchor[row], seg[row], (offset[row] + at).astype(np.int32), length.astype(np.int32)]
        return pa.table(dict(zip(("anchor", "seg", "offset", "n"), map(pa.array, columns), strict=True)))

    return run


def passage_batch(routes, anchors, segs, offsets, ns, weights, words: list[np.ndarray], width: int) -> pa.RecordBatch:
    ns = np.asarray(ns, np.int32)
    ends = np.concatenate([[0], np.cumsum(ns + width - 1)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(words).view(np.int64)))
    return pa.RecordBatch.from_arrays(
        [pa.array(routes, pa.int64()), pa.array(anchors, pa.int64()), pa.array(segs, pa.int64()),
         pa.array(offsets, pa.int32()), pa.array(ns), pa.array(weights, pa.int32()), lists],
        ["route", "anchor", "seg", "offset", "n", "weight", "words"],
    )


def fetch_words(width: int):
    """Maps text, wanted (structs of start, n, anchor, seg, weight) to PASSAGES, routed by their anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("wanted")
            ends, listed = wanted.offsets.to_numpy(), wanted.values
            start, n, anchor, seg, weight = (listed.field(c).to_numpy() for c in ("start", "n", "anchor", "seg", "weight"))
            words = []
            for i, text in enumerate(batch.column("text")):
                split = text.as_py().split()
                hashes = word_hashes(split, len(split))
                words.extend(hashes[start[j] : start[j] + n[j] + width - 1] for j in range(ends[i], ends[i + 1]))
            if words:
                own = slice(ends[0], ends[-1])
                yield passage_batch(anchor[own], anchor[own], seg[own], np.zeros(len(words)), n[own], weight[own], words, width)

    return run


def further_routes(hashes: np.ndarray, width: int, grams: int) -> np.ndarray:
    """For each window of a passage a hash of its ``grams`` smallest different grams."""
    ordered = np.sort(np.lib.stride_tricks.sliding_window_view(rolling(hashes, GRAM), width - GRAM + 1), axis=1)
    fresh = np.ones(ordered.shape, bool)
    fresh[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    fresh &= np.cumsum(fresh, axis=1) <= grams
    return mixed(np.where(fresh, mixed(ordered), np.uint64(0)).sum(axis=1, dtype=np.uint64))


def split_passages(width: int, grams: int):
    """Maps PASSAGES to PASSAGES that are routed by the ``grams`` smallest grams of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            routes, rows, offsets, ns, words = [], [], [], [], []
            for i, listed in enumerate(batch.column("words")):
                hashes = listed.values.to_numpy().view(np.uint64)
                route = further_routes(hashes, width, grams)
                start = np.concatenate([[0], np.flatnonzero(np.diff(route)) + 1])
                end = np.append(start[1:], len(route))
                routes.append(route[start].view(np.int64))
                offsets.append(start)
                ns.append(end - start)
                rows.append(np.full(len(start), i))
                words.extend(hashes[a : b + width - 1] for a, b in zip(start, end, strict=True))
            if words:
                row = np.concatenate(rows)
                anchors, segs, offset, weights = (batch.column(c).to_numpy()[row] for c in ("anchor", "seg", "offset", "weight"))
                yield passage_batch(np.concatenate(routes), anchors, segs, offset + np.concatenate(offsets), np.concatenate(ns), weights, words, width)

    return run


def heavy_keys(counted: DataFrame, by: list[str], times: str, rows: int) -> DataFrame:
    """The keys with more than 1 / HEAVY of all ``rows``, each with as many parts as bring it below that."""
    parts = F.ceil(F.col(times) * HEAVY / rows).cast("int").alias("_parts")
    return counted.filter(F.col(times) > rows / HEAVY).select(*by, parts)


def shared_rows(rows: DataFrame, keys: DataFrame, heavy: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` (key, start and more) joined with ``keys``, the rows of ``heavy`` keys dealt over their parts."""
    parts = F.coalesce("_parts", F.lit(1))
    heavy = F.broadcast(heavy)  # at most HEAVY rows, and at most twice as many parts in all
    dealt = rows.join(heavy, by, "left").withColumn("_part", F.pmod(F.xxhash64("key", "start"), parts).cast("int")).drop("_parts")
    copies = keys.join(heavy, by, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    # Always a shuffle: what travels grows in step with the input.
    return dealt.join(copies.hint("merge"), [*by, "_part"]).drop("_part")


def fitting(passages: DataFrame, width: int, shard_words: int) -> tuple[DataFrame, int]:
    """The passages with routes whose parts fit in a shard, and the number of shards for them."""
    settled, words, grams = [], 0, 1
    while True:
        sizes = stage(passages.groupBy("route").agg(F.sum(F.col("n") + width).alias("words")), "substring-routes")
        # No two different windows have all grams in common but for their order.
        over = sizes.filter(F.col("words") > shard_words).select("route") if grams <= width - GRAM else sizes.limit(0).select("route")
        words += sizes.agg(F.sum("words")).first()[0] or 0
        if over.isEmpty():
            settled.append(passages)
            break
        over = bounded_broadcast(over)
        settled.append(passages.join(over, "route", "left_anti"))
        grams += 1
        deeper = passages.join(over, "route", "left_semi").select(*passages.columns)
        passages = stage(deeper.mapInArrow(split_passages(width, grams), PASSAGES), "substring-split")
    return reduce(DataFrame.unionByName, settled), max(1, ceil(words / shard_words))


def repeats(docs: DataFrame, width: int = 35, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Runs of windows that occur elsewhere (key, start, n) in ``docs`` (key, text as bytes).

    Windows of repeated rows count once for each row.
    """
    found = stage(docs.mapInArrow(find_segments(width), SEGMENTS), "substring-segments")
    rows = found.count()
    anchors = stage(found.groupBy("anchor").agg(F.count("*").alias("all")).filter("all > 1"), "substring-anchors")
    heavy = heavy_keys(anchors, ["anchor"], "all", rows)
    shared = stage(shared_rows(found, anchors.select("anchor"), heavy, ["anchor"]), "substring-shared")
    forget(found)
    forget(anchors)
    kinds = shared.groupBy("anchor", "seg").agg(F.count("*").alias("times"), F.min(F.struct("key", "start", "n")).alias("at"))
    kinds = stage(kinds, "substring-kinds")
    x = F.struct("at.start", "at.n", "anchor", "seg", F.least("times", F.lit(2)).cast("int").alias("weight")).alias("x")
    wanted = kinds.select(F.col("at.key").alias("_key"), x).groupBy("_key").agg(F.collect_list("x").alias("wanted"))
    texts = docs.join(wanted.hint("merge"), F.col("key") == F.col("_key")).select("text", "wanted")
    passages = stage(texts.mapInArrow(fetch_words(width), PASSAGES), "substring-passages")
    passages, shards = fitting(passages, width, shard_words)
    routed = passages.withColumn("shard", F.pmod(F.col("route"), F.lit(shards)))
    hits = stage(routed.groupBy("shard").applyInArrow(shard_repeats(width), HITS), "substring-hits")
    hits = hits.withColumnRenamed("n", "length")
    heavy = heavy_keys(kinds, ["anchor", "seg"], "times", rows)
    spans = shared_rows(shared.select("key", "anchor", "seg", "start"), hits, heavy, ["anchor", "seg"])
    return spans.select("key", (F.col("start") + F.col("offset")).alias("start"), F.col("length").alias("n"))


KEPT = "n_words long, n_removed long, kept string"


def cut_spans(width: int):
    """Maps doc_id, text, spans (structs of start, n) to doc_id and KEPT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept = [], [], []
            spans = batch.column("spans")
            ends, listed = spans.offsets.to_numpy(), spans.values
            first, length = (listed.field(c).to_numpy() for c in ("start", "n"))
            for i, text in enumerate(batch.column("text")):
                words = text.as_py().split()
                gone = np.zeros(len(words) + 1, np.int32)
                own = slice(ends[i], ends[i + 1])
                np.add.at(gone, first[own], 1)
                np.add.at(gone, first[own] + length[own] + width - 1, -1)
                stay = np.cumsum(gone[:-1]) == 0
                sizes.append(len(words))
                removed.append(len(words) - int(stay.sum()))
                kept.append(b" ".join(words if stay.all() else [words[i] for i in np.flatnonzero(stay)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def without_repeats(docs: DataFrame, width: int = 35, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, n_removed and the kept words, joined by one blank.

    All occurrences go, the first one too, as windows are judged on the input. Null and empty texts
    have no words; texts shorter than a window stay; repeated rows are copies of each other; long
    texts are read whole; an empty table gives an empty result; other columns are ignored. Ids keep
    their type. Rows are named by a 64-bit hash of id and text.
    """
    keyed = docs.select("doc_id", F.xxhash64("doc_id", text_of()).alias("key"), text_of().cast("binary").alias("text"))
    spans = repeats(keyed.select("key", "text"), width, shard_words)
    # A set: repeated rows have one key and the same spans.
    spans = spans.groupBy(F.col("key").alias("_key")).agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    none = F.array().cast("array<struct<start:int,n:int>>")
    joined = keyed.join(spans.hint("merge"), F.col("key") == F.col("_key"), "left").select("doc_id", "text", F.coalesce("spans", none).alias("spans"))
    return joined.mapInArrow(cut_spans(width), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {KEPT}")


def op8(spark, sf_dir: str) -> DataFrame:
    """The query: what repeated passages leave of every document."""
    kept = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35)),
again AS (SELECT t FROM s GROUP BY t HAVING count(*) > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS p FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM s SEMI JOIN again USING (t)) GROUP BY doc_id),
marked AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w),
left_over AS (SELECT m.doc_id, string_agg(word, ' ' ORDER BY m.p) AS kept
  FROM marked m ANTI JOIN (SELECT doc_id, unnest(p) AS p FROM gone) g ON m.doc_id = g.doc_id AND m.p = g.p GROUP BY m.doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(p), 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""
