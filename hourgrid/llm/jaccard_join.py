"""Similarity join of texts on word n-grams: MinHash banding, exact verification.

A text is the set of its runs of five words (all of its words, if fewer). Two texts
are linked when the Jaccard similarity of their sets is at least 0.8.

1. Sets are hashed; texts with equal sets become one class, reduced in each task
   before the shuffle, so copies cost nothing further.
2. Each class has a MinHash signature, cut into bands. Band and row counts are
   chosen so that a pair at the threshold meets in some band with the wanted
   probability. Only (band hash, class) pairs are shuffled to find bands that
   hold more than one class.
3. In such a band, classes whose signatures agree clearly enough are tied
   together; only a spanning forest leaves the task. The tied classes form clusters.
4. Full sets are sent once to their cluster, where all pairs are compared exactly.
   What leaves the task are counts of links per class and a spanning forest.

A band or cluster above ``BLOCK`` classes is cut into blocks, and every pair of
blocks is a group of its own: memory per group is bounded, no pair is lost, and
no pair is ever emitted.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.llm import bloom
from hourgrid.llm.components import connected_components
from hourgrid.llm.frames import computed, in_groups, objects, stage

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999
HASHES = 160
SLACK = 0.2
BLOCK = 1024
CACHE = 100_000

_WORD = re.compile(r"\w+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return code


_hashes = _Hashes()


def choose_bands(similarity: float = SIMILARITY, recall: float = RECALL, most: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective rows whose bands reach the recall within ``most`` hashes."""
    for rows in range(16, 0, -1):
        bands = math.ceil(math.log(1.0 - recall) / math.log(1.0 - similarity**rows))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no banding reaches this recall")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct n-gram hashes of a text; empty if it has no word."""
    found = _WORD.findall((text or "").lower())
    codes = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    size = min(words, len(codes))
    if not size:
        return codes
    total = np.full(len(codes) - size + 1, size, np.uint64)
    for k in range(size):
        total = total * _FACTOR + codes[k : len(codes) - size + 1 + k]
    return np.unique(_mixed(total))


def signature(grams: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """MinHash values of a set, worked off in pieces so that memory stays bounded."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for begin in range(0, len(grams), 512):
        np.minimum(least, (factors[:, None] * grams[None, begin : begin + 512]).min(axis=1), out=least)
    return least


def _factors(count: int) -> np.ndarray:
    return _mixed(np.arange(1, count + 1, dtype=np.uint64) * _FACTOR) | np.uint64(1)


def _key(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, as two signed longs."""
    digest = xxhash.xxh128_digest(grams.tobytes())
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def _id(docs: DataFrame, id_col: str) -> Column:
    """The id, whole numbers as longs."""
    return F.col(id_col).cast("long") if isinstance(docs.schema[id_col].dataType, T.IntegralType) else F.col(id_col)


def _classes(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """(members, classes): rows with their set's key, and one row per distinct set."""
    factors = _factors(bands * rows)

    def sketch(texts: list[str | None]) -> list[list]:
        powers, made = _factors(rows), []
        for text in texts:
            grams = shingles(text, words)
            values = signature(grams, factors)
            folded = (_mixed(values).reshape(bands, rows) * powers).sum(axis=1, dtype=np.uint64)
            # The band's number goes into its hash: bands only meet their like.
            hashes = _mixed(folded + np.arange(bands, dtype=np.uint64)).view(np.int64)
            marks = (_mixed(values) & np.uint64(255)).astype(np.uint8).tobytes()
            made.append((*_key(grams), len(grams), hashes, marks))
        return list(zip(*made, strict=True)) if made else [[] for _ in fields]

    fields = [
        T.StructField("key1", T.LongType()),
        T.StructField("key2", T.LongType()),
        T.StructField("grams", T.IntegerType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("sketch", T.BinaryType()),
    ]
    texts = docs.select(F.monotonically_increasing_id().alias("row"), _id(docs, id_col).alias("id"), F.col(text_col).alias("text"))
    members = stage(computed(texts, ["text"], sketch, fields, ["text"]))
    same = members.where("grams > 0").groupBy("key1", "key2").agg(
        F.min("row").alias("cid"), F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    first = members.select(F.col("row").alias("cid"), "grams", "bands", "sketch")
    return members, stage(same.join(first, "cid"))


def _blocks(df: DataFrame, size: Column, block: int) -> DataFrame:
    """Send each row to every pair of blocks that its own block takes part in.

    Adds ``bi`` <= ``bj`` (the group) and ``own`` (the row's block).
    """
    cut = df.withColumn("parts", F.ceil(size / block).cast("int")).withColumn("own", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    return cut.select("*", other).withColumn("bi", F.least("own", "other")).withColumn("bj", F.greatest("own", "other")).drop("other", "parts")


def _forest(count: int, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The smallest member of each row's component, rows numbered in order."""
    root = np.arange(count)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in zip(*pairs, strict=True):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(count)])


def _candidates(classes: DataFrame, least: float, block: int) -> DataFrame:
    """Spanning edges (a, b) between classes that share a band and agree in their signatures."""
    bands = classes.select("cid", F.explode("bands").alias("band"))
    full = bands.groupBy("band").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    shared = bands.join(full, "band").join(classes.select("cid", "sketch"), "cid")

    def tie(group: pd.DataFrame) -> pd.DataFrame | None:
        n = len(group)
        if n < 2:
            return None
        cid, own = group["cid"].to_numpy(), group["own"].to_numpy()
        marks = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(n, -1)
        cross, left, right = bool((own != own[0]).any()), [], []
        for i in range(n - 1):
            near = np.flatnonzero((marks[i + 1 :] == marks[i]).mean(axis=1) >= least) + i + 1
            near = near[own[near] != own[i]] if cross else near
            left += [i] * len(near)
            right += near.tolist()
        root = _forest(n, (np.array(left, int), np.array(right, int)))
        tied = root != np.arange(n)
        return pd.DataFrame({"a": cid[tied], "b": cid[root[tied]]}) if tied.any() else None

    cut = _blocks(shared, F.col("m"), block).select("band", "bi", "bj", "own", "cid", "sketch")
    return in_groups(cut, ["band", "bi", "bj"], ["cid"], tie, "a long, b long")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, through the n-grams that two sets or more hold."""
    lengths = [len(s) for s in sets]
    owner = np.repeat(np.arange(len(sets)), lengths)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = times[column] > 1
    owner, column = owner[keep], column[keep]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for begin in range(0, width, 2048):
        lo, hi = np.searchsorted(column, [begin, begin + 2048])
        table = np.zeros((len(sets), min(2048, width - begin)), np.float32)
        table[owner[lo:hi], column[lo:hi] - begin] = 1.0
        total += table @ table.T
    return total


def _verify(sets: DataFrame, least: float, block: int) -> DataFrame:
    """Exact links inside clusters: (cid, root, links, linked_docs) per class and group."""

    def compare(group: pd.DataFrame) -> pd.DataFrame | None:
        group = group.drop_duplicates("cid")
        n = len(group)
        if n < 2:
            return None
        cid, own, copies = group["cid"].to_numpy(), group["own"].to_numpy(), group["copies"].to_numpy()
        grams = [np.frombuffer(g, np.uint64) for g in group["set"]]
        size = np.array([len(g) for g in grams], np.float64)
        if n <= 3:
            both = np.zeros((n, n))
            for i in range(n):
                for j in range(i):
                    both[i, j] = both[j, i] = len(np.intersect1d(grams[i], grams[j], assume_unique=True))
        else:
            both = _overlaps(grams).astype(np.float64)
        linked = both >= least * (size[:, None] + size[None, :] - both) - 1e-9
        np.fill_diagonal(linked, False)
        if (own != own[0]).any():
            linked &= own[:, None] != own[None, :]
        root = _forest(n, np.nonzero(np.triu(linked)))
        some = linked.any(axis=1)
        return pd.DataFrame(
            {"cid": cid, "root": cid[root], "links": linked.sum(axis=1), "linked_docs": linked @ copies}
        )[some]

    cut = _blocks(sets, F.col("m"), block).select("cluster", "bi", "bj", "own", "cid", "copies", "set")
    return in_groups(cut, ["cluster", "bi", "bj"], ["cid"], compare, "cid long, root long, links long, linked_docs long")


def _sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Full sets of the classes in ``wanted`` (cluster, m, cid, rep, key1, key2, copies), from one reading of the texts."""
    bits = docs.sparkSession.sparkContext.broadcast(bloom.build(wanted.select(F.xxhash64("rep").alias("k")), "k"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[bloom.contains(bits.value, batch["k"].to_numpy(np.int64))]
            grams = [shingles(t, words) for t in batch["text"]]
            keys = [_key(g) for g in grams]
            made = {"key1": [k[0] for k in keys], "key2": [k[1] for k in keys], "set": [g.tobytes() for g in grams]}
            yield pd.DataFrame({"k": objects(batch["k"].tolist()), **{n: objects(v) for n, v in made.items()}})

    texts = docs.select(F.xxhash64(_id(docs, id_col)).alias("k"), F.col(text_col).alias("text"))
    sets = texts.mapInPandas(run, "k long, key1 long, key2 long, set binary")
    return sets.join(wanted.withColumn("k", F.xxhash64("rep")), ["k", "key1", "key2"])


def similar_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    least: float = SIMILARITY,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: id, class_id, text_id, copies, n_links, n_linked_docs.

    ``class_id`` is the smallest id among all documents joined by links, directly or
    over others; ``text_id`` the smallest id with the same n-gram set, ``copies``
    their number. ``n_links`` counts the other texts (distinct sets) that the
    document is similar to, ``n_linked_docs`` the other documents: the copies of
    those texts and its own. Defined cases: a NULL text, or one without a word, has no links
    and is its own class; a NULL id is larger than any other; repeated rows are
    copies; an empty table gives an empty result; further columns are ignored.
    """
    bands, rows = choose_bands(least, recall)
    members, classes = _classes(docs, id_col, text_col, words, bands, rows)
    edges = _candidates(classes, max(0.0, least - SLACK), block)
    clusters = stage(connected_components(edges))
    sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    wanted = stage(
        clusters.join(sizes, "root")
        .select(F.col("node").alias("cid"), F.col("root").alias("cluster"), "m")
        .join(classes.select("cid", "rep", "key1", "key2", "copies"), "cid")
    )
    found = stage(_verify(_sets_of(docs, wanted, id_col, text_col, words), least, block))
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"), F.sum("linked_docs").alias("linked_docs"))
    groups = stage(connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b"))))
    named = classes.select("cid", "key1", "key2", F.col("rep").alias("text_id"), "copies").join(
        counts, "cid", "left"
    ).join(groups.withColumnRenamed("node", "cid"), "cid", "left")
    names = named.where("root IS NOT NULL").groupBy("root").agg(F.min("text_id").alias("group_id"))
    named = named.join(names, "root", "left").select("key1", "key2", "text_id", "copies", "links", "linked_docs", "group_id")
    worded = F.col("grams") > 0
    nothing = F.lit(0).cast("long")
    return members.select("id", "key1", "key2", "grams").join(stage(named), ["key1", "key2"], "left").select(
        F.col("id").alias(id_col),
        F.when(worded, F.coalesce("group_id", "text_id")).otherwise(F.col("id")).alias("class_id"),
        F.when(worded, F.col("text_id")).otherwise(F.col("id")).alias("text_id"),
        F.when(worded, F.col("copies")).otherwise(F.lit(1)).cast("long").alias("copies"),
        F.coalesce("links", nothing).alias("n_links"),
        F.when(worded, F.coalesce("linked_docs", nothing) + F.col("copies") - 1).otherwise(nothing).alias("n_linked_docs"),
    )


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document per class, the one with the smallest id; same columns.

    Rows that share an id are kept or dropped together; a row with a NULL id stays.
    """
    groups = similar_groups(docs, id_col, text_col, **options)
    dropped = groups.where(F.col("class_id") < F.col(id_col)).select(F.col(id_col).alias("__dropped")).distinct()
    return docs.join(stage(dropped), F.col(id_col) == F.col("__dropped"), "left_anti")
