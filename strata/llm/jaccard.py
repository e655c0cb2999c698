"""Operator 4: an exact n-gram Jaccard join by a size-aware heavy-light split.

The set of a document is its distinct word shingles. Two documents link when
``100 * intersection >= 80 * union``; the result is the components of these links.

Small sets: for each pair of sizes that can link, every set enumerates its subsets of the one size
that a link needs. Sets that share such a subset are linked and no others are, so the components
come out of a grouping, without pairs.

Large sets: shingles are ordered from rare to frequent, and only the first ones of each set, enough to meet
in any link, are entered in inverted lists. The lists are scanned in two rounds. First every set is
compared with one pivot per list, the set in which the shingle comes earliest, which joins most of a
group of near copies in work that is linear in the list. Then pairs of the lists that are still in different
components and pass the bounds on size, position and a bitmap are compared. All comparisons are
exact, on whole sets.

The boundary between small and large is where enumerating subsets would cost more than scanning the
lists that the same sets would be in; both costs are summed up over all sets of each size.

Rarity only decides the order, not the result: it is counted over the corpus by tasks that report
shingles seen twice or more, and the most frequent ones (a bounded number) are told apart.
Shingles and texts are named by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import bounded_broadcast, columns_of, mixed, rolling, text_of, whole_row, word_hashes
from strata.session import stage

WIDTH = 5
SMALL = 24  # sets of up to so many shingles may be enumerated
FREQUENT = 500_000  # shingles that are told apart by frequency
SEEN = 8  # least count of those
CHUNK = 2_000_000  # shingles that a task counts at a time
SUBSET_ROWS = 50_000  # subsets (26 bytes each) that a task holds at a time
EDGES = 50_000  # edges of which a task writes at least so many, where there are more tasks than cores
NEEDED = 1_000_000  # keys (8 bytes each) of texts to compare that are broadcast; more are joined by a shuffle


def shingles(text: bytes) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; a text of fewer words is one shingle."""
    words = text.lower().split()  # bytes: A-Z only, and blanks of ASCII only
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(rolling(word_hashes(words, len(words)), min(WIDTH, len(words))))


def least_overlap(a, b):
    """The smallest intersection with which sets of these sizes link: 4/9 of the sum, rounded up."""
    return (4 * (a + b) + 8) // 9


def partners(n: int, most: int = SMALL) -> list[int]:
    """Sizes up to ``most`` that a set of ``n`` can link with."""
    return [m for m in range(1, most + 1) if least_overlap(n, m) <= min(n, m)]


@cache
def left_out(n: int, size: int) -> np.ndarray:
    """Which elements each subset of ``size`` of ``n`` elements leaves out."""
    return np.array(list(combinations(range(n), n - size)), np.int64).reshape(comb(n, size), n - size)


def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that several texts of a chunk have in common, with counts. Copies in a task count once."""
    seen: set[int] = set()
    held: list[np.ndarray] = []
    size = 0

    def counted() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        often = counts > 1
        return pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(counts[often])], ["shingle", "n"])

    for batch in batches:
        for key, text in zip(batch.column("key").to_numpy(), batch.column("text"), strict=True):
            if key in seen:
                continue
            if len(seen) < CHUNK:
                seen.add(key)
            held.append(shingles(text.as_py()))
            size += len(held[-1])
            if size > CHUNK:
                yield counted()
                held, size = [], 0
    if size:
        yield counted()


SETS = "key long, n int, prefix array<long>, sketch binary, small array<long>"


def sketch(values: np.ndarray) -> bytes:
    """A bitmap of at least two bits per element, its size a power of two."""
    width = max(64, 1 << int(2 * len(values) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(values & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def make_sets(shared):
    """Maps key, text (bytes) to SETS. ``shared``: a broadcast of sorted frequent shingles and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value
        seen: set[int] = set()
        for batch in batches:
            keys, sizes, prefixes, sketches, small = [], [], [], [], []
            for key, text in zip(batch.column("key").to_numpy(), batch.column("text"), strict=True):
                if key in seen:
                    continue
                if len(seen) < CHUNK:
                    seen.add(key)
                values = shingles(text.as_py())
                n = len(values)
                if not n:
                    continue
                often = np.zeros(n, np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
                    often = np.where(known[at] == values, counts[at], 0)
                order = np.lexsort((values, often))
                keys.append(key)
                sizes.append(n)
                prefixes.append(values[order[: n - (4 * n + 4) // 5 + 1]].view(np.int64))
                sketches.append(sketch(values))
                small.append(values.view(np.int64) if n <= SMALL else None)
            if keys:
                ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(prefixes)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), lists, pa.array(sketches, pa.binary()), pa.array(small, pa.list_(pa.int64()))],
                    ["key", "n", "prefix", "sketch", "small"],
                )

    return run


SUBSETS = "k1 long, k2 long, key long, large boolean, even boolean"


def subsets(boundary: int):
    """Maps key, small to SUBSETS: hashes of the subsets that links between small sets need.

    A set of 24 has 25,576 of them, so a batch of sets goes out in many batches of subsets.
    """

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["k1", "k2", "key", "large", "even"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for key, small in zip(batch.column("key").to_numpy(), batch.column("small"), strict=True):
                values = np.array(small.as_py(), np.int64).view(np.uint64)
                n = len(values)
                one, two = mixed(values), mixed(values ^ np.uint64(0xD1B54A32D192ED03))
                for m in partners(n, boundary):
                    out = left_out(n, least_overlap(n, m))
                    pair = np.uint64(min(n, m) * 64 + max(n, m))
                    rest = [mixed(v.sum() - v[out].sum(1) + pair).view(np.int64) for v in (one, two)]
                    rows.append((*rest, np.full(len(out), key), np.full(len(out), n > m), np.full(len(out), n == m)))
                    size += len(out)
                    if size >= SUBSET_ROWS:
                        yield batch_of(rows)
                        rows, size = [], 0
            if rows:
                yield batch_of(rows)

    return run


def small_links(sets: DataFrame, boundary: int) -> DataFrame:
    """Edges (u, v) that connect exactly the linked sets of up to ``boundary`` shingles."""
    keys = sets.filter(F.col("n") <= boundary).select("key", "small").mapInArrow(subsets(boundary), SUBSETS)
    keys = stage(keys.distinct(), "jaccard-subsets")
    meet = keys.groupBy("k1", "k2").agg(
        F.min("key").alias("v"), F.max("key").alias("w"), F.max("even").alias("even"), F.min("large").alias("lo"), F.max("large").alias("hi")
    )
    # Sets of both sizes of a pair, or several of the one size.
    meet = stage(meet.filter("v <> w and (even or lo <> hi)").select("k1", "k2", "v"), "jaccard-subsets-met")
    return keys.join(meet, ["k1", "k2"]).filter("key <> v").select(F.col("key").alias("u"), "v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(key, root) for every node of ``edges`` (u, v) that isn't the smallest of its component.

    Large-star and small-star steps in turns until nothing changes; each turn is written, few edges in few files.
    """
    cores = edges.sparkSession.sparkContext.defaultParallelism

    def sign(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "components")
    before = None
    while (state := sign(now)) != before:
        before = state
        files = max(cores, state[0] // EDGES)  # a step adds no more edges than there are
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large.coalesce(files), "components-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(small.union(low.select("u", "m")).distinct().coalesce(files), "components")
    return now.select(F.col("u").alias("key"), F.col("v").alias("root"))


def possible(a: str, b: str, pos_a: str, pos_b: str) -> Column:
    """Bounds for sets of sizes ``a`` and ``b`` whose first common shingle is at these places."""
    need = F.floor((4 * (F.col(a) + F.col(b)) + 8) / 9)
    return (need <= F.least(a, b)) & (need <= F.least(F.col(a) - F.col(pos_a), F.col(b) - F.col(pos_b)))


def by_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs a, b, na, nb, sa, sb that their bitmaps don't rule out, with the bound on their overlap."""
    for batch in batches:
        na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
        bound = np.zeros(len(na), np.int64)
        for i, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"), strict=True)):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            while len(x) > len(y):
                x = x[: len(x) // 2] | x[len(x) // 2 :]
            while len(y) > len(x):
                y = y[: len(y) // 2] | y[len(y) // 2 :]
            bound[i] = min(na[i] - np.bitwise_count(x & ~y).sum(), nb[i] - np.bitwise_count(y & ~x).sum())
        keep = np.flatnonzero(bound >= least_overlap(na.astype(np.int64), nb.astype(np.int64)))
        at = pa.array(keep)
        yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at), pa.array(bound[keep])], ["a", "b", "bound"])


def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs a, b, ta, tb (texts) whose sets link."""
    sets: dict[int, np.ndarray] = {}

    def of(key: int, text: pa.BinaryScalar) -> np.ndarray:
        if key not in sets:
            if len(sets) >= 64:
                sets.clear()
            sets[key] = shingles(text.as_py())
        return sets[key]

    for batch in batches:
        keep = []
        for i, (a, b, ta, tb) in enumerate(zip(*(batch.column(c) for c in ("a", "b", "ta", "tb")), strict=True)):
            x, y = of(a.as_py(), ta), of(b.as_py(), tb)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= 80 * (len(x) + len(y) - both):
                keep.append(i)
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], ["u", "v"])


def screened(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) that their bitmaps leave possible: a, b, bound."""
    a = sketches.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = sketches.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    return pairs.join(a, "a").join(b, "b").mapInArrow(by_sketch, "a long, b long, bound long")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, as edges (u, v). Only texts that a pair needs travel to it."""
    needed = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    needed = bounded_broadcast(stage(needed, "jaccard-needed"), NEEDED)
    texts = stage(docs.join(needed, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")), "jaccard-texts")
    a, b = (texts.select(F.col("key").alias(c), F.col("text").alias(f"t{c}")) for c in "ab")
    return pairs.select("a", "b").join(a, "a").join(b, "b").mapInArrow(linked, "u long, v long")


def pick_boundary(sets: DataFrame, lists: DataFrame) -> int:
    """The largest size up to which enumerating subsets costs no more than scanning lists."""
    small = F.col("n") <= SMALL
    number = dict(sets.filter(small).groupBy("n").agg(F.count("*")).collect())
    scanned = dict(lists.filter(small).groupBy("n").agg(F.sum("members")).collect())
    best, light, heavy = 0, 0, 0
    for n in range(1, SMALL + 1):
        rows = number.get(n, 0)
        light += rows * sum(comb(n, least_overlap(n, m)) for m in partners(n))
        heavy += rows * (n - (4 * n + 4) // 5 + 1) + scanned.get(n, 0)
        best = n if light <= heavy else best
    return best


def link_sets(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From key, text (bytes): sizes (key, n) of all sets that aren't empty, and (key, root) of linked ones."""
    spark = keyed.sparkSession
    often = keyed.mapInArrow(frequent, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).filter(F.col("n") >= SEEN)
    often = often.orderBy(F.desc("n"), "shingle").limit(FREQUENT).toArrow()
    values = often.column("shingle").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(values)
    shared = spark.sparkContext.broadcast((values[order], often.column("n").to_numpy().astype(np.int64)[order]))
    sets = stage(keyed.mapInArrow(make_sets(shared), SETS), "jaccard-sets")
    posted = sets.select("key", "n", F.posexplode("prefix").alias("pos", "shingle"))
    met = posted.groupBy("shingle").agg(F.min("key").alias("k"), F.max("key").alias("l"), F.count("*").alias("members")).filter("k <> l")
    lists = stage(posted.join(met.select("shingle", "members"), "shingle"), "jaccard-lists")
    boundary = pick_boundary(sets, lists)
    sketches = stage(sets.select("key", "n", "sketch").dropDuplicates(["key"]), "jaccard-sketches")
    light = small_links(sets, boundary)

    pivots = lists.groupBy("shingle").agg(F.min(F.struct("pos", "key", "n")).alias("p"))
    pivots = stage(pivots.select("shingle", F.col("p.key").alias("b"), F.col("p.n").alias("nb"), F.col("p.pos").alias("pos_b")), "jaccard-pivots")
    stars = lists.filter(F.col("n") > boundary).join(pivots, "shingle").filter("key <> b").filter(possible("n", "nb", "pos", "pos_b"))
    stars = screened(stars.select(F.col("key").alias("a"), "b").distinct(), sketches)
    best = stars.groupBy("a").agg(F.max(F.struct("bound", "b")).alias("p")).select("a", F.col("p.b").alias("b"))
    best = stage(best, "jaccard-stars")
    first = stage(verified(best, keyed).union(light), "jaccard-links")
    roots = stage(components(first), "jaccard-roots")

    root = F.coalesce("root", "key").alias("root")
    named = stage(lists.join(roots, "key", "left").select("shingle", "key", "n", "pos", root).distinct(), "jaccard-named")
    open_lists = stage(named.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("shingle"), "jaccard-open")
    named = stage(named.join(open_lists, "shingle"), "jaccard-left")
    a = named.filter(F.col("pos") <= F.col("n") - F.floor((8 * F.col("n") + 8) / 9)).toDF("shingle", "a", "na", "pos_a", "ra")
    b = named.toDF("shingle", "b", "nb", "pos_b", "rb")
    rest = a.join(b, "shingle").filter("ra <> rb and (na < nb or na = nb and a < b)").filter(possible("na", "nb", "pos_a", "pos_b"))
    rest = rest.filter(F.col("nb") > boundary).select("a", "b").distinct()
    tested = best.union(best.select("b", "a"))
    rest = stage(screened(rest.join(tested, ["a", "b"], "left_anti"), sketches), "jaccard-rest")
    more = verified(rest, keyed)

    u, v = (roots.select(F.col("key").alias(c), F.col("root").alias(f"r{c}")) for c in "uv")
    more = more.join(u, "u", "left").join(v, "v", "left").select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v"))
    again = stage(components(more), "jaccard-roots-again")
    known = roots.select("key", F.col("root").alias("mid")).join(again.select(F.col("key").alias("mid"), F.col("root").alias("top")), "mid", "left")
    known = known.select("key", F.coalesce("top", "mid").alias("root"))
    alone = again.join(roots.select("key"), "key", "left_anti")
    return sketches.select("key", "n"), stage(known.union(alone), "jaccard-components")


def link_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): _key, n_shingles, _root, component_id.

    ``component_id`` is the smallest doc_id that links reach. Null and empty texts and those of blanks have empty
    sets and link with nothing, themselves excepted; repeated rows link with each other; rows without an id
    take part, and a component of such rows alone has none. Texts are read whole. An empty table gives no rows;
    other columns are ignored.
    """
    keyed = docs.select(F.xxhash64(text_of()).alias("key"), text_of().cast("binary").alias("text"))
    sizes, roots = link_sets(keyed)
    rows = docs.select("doc_id", F.xxhash64(text_of()).alias("_key"))
    rows = rows.join(sizes.withColumnRenamed("key", "k"), F.col("_key") == F.col("k"), "left").drop("k")
    rows = rows.join(roots.withColumnRenamed("key", "k"), F.col("_key") == F.col("k"), "left").drop("k")
    rows = rows.select("doc_id", "_key", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"), F.coalesce("root", "_key").alias("_root"))
    rows = stage(rows, "jaccard-rows")
    least = stage(rows.groupBy("_root").agg(F.min("doc_id").alias("_least")).withColumnRenamed("_root", "r"), "jaccard-least")
    rows = rows.join(least, F.col("_root") == F.col("r"))
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("_least"))
    return rows.select("doc_id", "_key", "n_shingles", "_root", own.alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns: of each component the one with the smallest doc_id.

    Of repeated rows with that id one stays (any, if other columns differ). Rows with empty sets all stay.
    """
    found = link_documents(docs.select("doc_id", "text"))
    first = found.filter("n_shingles > 0").groupBy("_root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key")).alias("f"))
    keep = first.select("f.doc_id", "f._key").withColumn("_one", F.lit(True))
    keep = keep.union(found.filter("n_shingles = 0").select("doc_id", "_key", F.lit(False)).distinct())
    keep = stage(keep.toDF("_doc", "_text", "_one"), "jaccard-kept")
    rows = docs.select(whole_row(docs), F.col("doc_id").alias("_id"), F.xxhash64(text_of()).alias("_key"))
    rows = rows.join(keep, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_text")))
    nth = F.row_number().over(Window.partitionBy("_id", "_key").orderBy("_one"))
    rows = rows.withColumn("_nth", nth).filter("not _one or _nth = 1")
    return rows.select(*columns_of(docs))


def op4(spark, sf_dir: str) -> DataFrame:
    """The query: set sizes and components of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return link_documents(docs).select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(list_slice(w, i, i + least(len(w), 5) - 1), ' ')) AS t
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT doc_id AS root, doc_id AS d FROM documents UNION SELECT r.root, e.b FROM r JOIN e ON r.d = e.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT d AS doc_id, min(root) AS component_id FROM r GROUP BY d) c USING (doc_id)
"""
