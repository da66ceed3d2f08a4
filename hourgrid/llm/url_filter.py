"""Url verdicts: explicit rules first, then naive Bayes on segmented host and path words.

Host names run words together. A unigram model over the words of page titles and
url paths splits each host label by Viterbi search; a multinomial naive
Bayes model then scores the host's words and the path's words.

The word counts stay a DataFrame however many words there are. Each distinct host label sends the stretches
of it that may be words, as a filter of the words says, to a join with the counts, and is split with
what comes back: exactly the words that the whole table has in it, at their shares of all words.

Labels come from seed words: a host whose own words hold one is a bad example,
every other host a good one. The model is counted over all urls and so
learns which further words keep company with the seeds; ``hidden_seeds`` measures whether it
finds bad hosts without them. Naive Bayes counts live in ``BUCKETS`` hashed cells, a bounded model size.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.llm import bloom
from hourgrid.llm.frames import computed, objects, shuffle_partitions, stage
from hourgrid.llm.html_main import host_of

# Words that mark unwanted hosts, and plain words that help segmentation.
SEEDS = (
    "adult ads advert affiliate bet bets betting bonus casino cheap clickbait crack dating escort gambling hacked "
    "jackpot keygen lottery malware nude payday phishing pills poker porn replica sex sexy slots spam spammer torrent "
    "tracker viagra warez webcam xxx"
).split()
PLAIN = (
    "about and best blog book city club daily day farm first food for free from game games good group guide health "
    "home house info life live market media music net new news now of online open page park people photo press radio "
    "school science shop site sport sports star store the time times today top track travel web wiki win work world"
).split()
BUCKETS = 1 << 18
SMOOTHING = 0.5
NUMBER = "<number>"


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for NULL and urls without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest fitting (verdict, host, path) rule, or NULL.

    A rule fits its host and all subdomains when the url's path starts with the
    rule's. Rules are an argument of the caller and become one expression; of
    rules of equal length the block wins.
    """
    fitting = [
        F.when(
            ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path),
            F.struct(
                F.lit(len(rule_host + rule_path)).alias("length"),
                F.lit(verdict).alias("verdict"),
                F.lit(rule_host + rule_path).alias("rule"),
            ),
        )
        for verdict, rule_host, rule_path in rules
    ]
    return F.array_max(F.array_compact(F.array(*fitting))) if fitting else F.lit(None).cast("struct<length:int,verdict:string,rule:string>")


def _floor(total: float) -> float:
    """Seed and plain words count at least this often, so that rare names still split at them."""
    return max(1.0, total / 1e5)


class Segmenter:
    """Viterbi split of a string into the most likely words of a unigram model.

    With ``total`` the counts are those of the words that may be in the string, of a table with
    so many words in all; else they are the whole table.
    """

    def __init__(self, counts: dict[str, float], total: float | None = None) -> None:
        words = dict(counts)
        if total is None:
            floor = _floor(sum(words.values()))
            for w in (*SEEDS, *PLAIN):
                words[w] = max(words.get(w, 0), floor)
            total = sum(words.values())
        log_total = math.log(total or 1.0)
        self.cost = {w: log_total - math.log(n) for w, n in words.items() if n > 0}
        self.unknown = log_total
        self.lengths = sorted({len(w) for w in self.cost}, reverse=True)

    def split(self, text: str) -> list[str]:
        """Unknown stretches stay whole: one costs more than any known word, plus some per letter."""
        n = len(text)
        known, blank = [0.0] + [math.inf] * n, [math.inf] * (n + 1)
        back_known: list[tuple[int, bool]] = [(0, False)] * (n + 1)
        back_blank: list[tuple[int, bool]] = [(0, False)] * (n + 1)
        for end in range(1, n + 1):
            for begin in (end - length for length in self.lengths if length <= end):
                cost = self.cost.get(text[begin:end])
                if cost is not None:
                    before, from_blank = min((known[begin], False), (blank[begin], True))
                    if before + cost < known[end]:
                        known[end], back_known[end] = before + cost, (begin, from_blank)
            # A blank letter opens an unknown stretch after a word, or goes on with one.
            opened, carried = known[end - 1] + self.unknown, blank[end - 1]
            blank[end] = min(opened, carried) + 2.5
            back_blank[end] = (end - 1, carried <= opened)
        words, end, in_blank = [], n, blank[n] < known[n]
        while end > 0:
            if in_blank:
                begin, still = back_blank[end]
                stop = end
                while still:
                    begin, still = back_blank[begin]
                words.append(text[begin:stop])
                end, in_blank = begin, False
            else:
                begin, in_blank = back_known[end]
                words.append(text[begin:end])
                end = begin
        return words[::-1]


_TOKEN = re.compile(r"[^\W\d_]+|\d+")


def host_words(host: str, segmenter: Segmenter) -> list[str]:
    found: list[str] = []
    for piece in _TOKEN.findall(host):
        found += [NUMBER] if piece.isdigit() else segmenter.split(piece)
    return found


def path_words(path: str) -> list[str]:
    return [NUMBER if p.isdigit() else p for p in _TOKEN.findall(path.lower())]


def _cell(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


def word_counts(pages: DataFrame, url_col: str, html_col: str | None) -> DataFrame:
    """Counted words of url paths and, with ``html_col``, of page titles."""
    texts = [path_of(F.col(url_col))]
    if html_col is not None:
        texts.append(F.regexp_extract(F.coalesce(html_col, F.lit("")), r"(?is)<title[^>]*>(.*?)</title", 1))
    text = F.lower(F.concat_ws(" ", *texts))
    words = F.regexp_extract_all("t", F.lit(r"\p{L}{2,}"), F.lit(0))
    words = pages.select(text.alias("t")).select(F.explode(words).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _key(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) - (1 << 63)


def segment_hosts(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, words) for distinct hosts, split with all of the word counts (word, n).

    A label's stretches of lengths that words have are looked up in a filter of the words, and those
    that pass are joined to the counts. Nothing of the words' or the hosts' number reaches the driver.
    """
    spark = hosts.sparkSession
    total = counts.agg(F.sum("n")).first()[0] or 0
    floor = _floor(total)
    raised = spark.createDataFrame([(w, floor) for w in {*SEEDS, *PLAIN}], "word string, n double")
    known = counts.select("word", F.col("n").cast("double").alias("n")).unionByName(raised)
    known = known.groupBy("word").agg(F.max("n").alias("n"))

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(key=[_key(w) for w in batch["word"]], length=[len(w) for w in batch["word"]])

    known = stage(known.mapInPandas(keyed, "word string, n double, key long, length int"))
    all_words = known.agg(F.sum("n")).first()[0]
    lengths = sorted(r[0] for r in known.select("length").distinct().collect())  # as many as words have lengths
    bits = spark.sparkContext.broadcast(bloom.build(known.select("key"), "key"))

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for label in batch["label"]:
                for length in lengths:
                    found = list({label[i : i + length] for i in range(len(label) - length + 1)})
                    if found:
                        passed = bloom.contains(bits.value, np.array([_key(w) for w in found], np.int64))
                        found = [w for w, p in zip(found, passed, strict=True) if p]
                    if found:
                        yield pd.DataFrame({"label": label, "word": found})

    # A host's pieces in order; digits are no label.
    pieces = F.regexp_extract_all("host", F.lit(r"\p{L}+|\p{Nd}+"), F.lit(0))
    placed = hosts.select("host", F.posexplode(pieces).alias("place", "label"))
    labels = placed.where(F.col("label").rlike(r"^\p{L}")).select("label").distinct()
    parts = max(shuffle_partitions(spark), 1)
    candidates = labels.repartition(parts).mapInPandas(stretches, "label string, word string")
    priced = candidates.join(known.select("word", "n"), "word").groupBy("label").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = []
            for label, known in zip(batch["label"], batch["known"], strict=True):
                words.append(Segmenter({k["word"]: k["n"] for k in known} if known is not None else {}, all_words).split(label))
            yield pd.DataFrame({"label": batch["label"], "words": objects(words).values})

    split_labels = stage(labels.join(priced, "label", "left").mapInPandas(split, "label string, words array<string>"))
    of_piece = placed.join(split_labels, "label", "left").withColumn("words", F.coalesce("words", F.array(F.lit(NUMBER))))
    in_order = F.sort_array(F.collect_list(F.struct("place", "words")))
    words = of_piece.groupBy("host").agg(F.flatten(F.transform(in_order, lambda p: p["words"])).alias("words"))
    return hosts.select("host").distinct().join(words, "host", "left").withColumn(
        "words", F.coalesce("words", F.array().cast("array<string>"))
    )


def _count_cells(distinct: DataFrame, marks: frozenset[str]) -> tuple[np.ndarray, float]:
    """Log odds of "bad" per cell and of the classes, from distinct urls (host, path, words)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells: dict[tuple[bool, int], int] = {}
        for batch in batches:
            for words, path in zip(batch["words"], batch["path"], strict=True):
                own = path_words(path)
                bad = not marks.isdisjoint(words) or not marks.isdisjoint(own)
                for cell in [-1, *map(_cell, words), *map(_cell, own)]:  # -1 counts urls
                    cells[bad, cell] = cells.get((bad, cell), 0) + 1
        yield pd.DataFrame({"bad": [k[0] for k in cells], "cell": [k[1] for k in cells], "n": list(cells.values())})

    cells = distinct.mapInPandas(count, "bad boolean, cell int, n long").groupBy("bad", "cell").agg(F.sum("n").alias("n"))
    table, classes = np.zeros((2, BUCKETS)), np.ones(2)
    for bad, cell, n in cells.collect():  # at most two rows per cell of the fixed-size model
        if cell < 0:
            classes[int(bad)] += n
        else:
            table[int(bad), cell] = n
    used = max(1, int((table.sum(axis=0) > 0).sum()))
    share = (table + SMOOTHING) / (table.sum(axis=1, keepdims=True) + SMOOTHING * used)
    return np.log(share[1] / share[0]).astype(np.float32), float(np.log(classes[1] / classes[0]))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = (),
    url_col: str = "url",
    html_col: str | None = "html",
    seeds: Sequence[str] = tuple(SEEDS),
) -> DataFrame:
    """``pages`` without the html, with ``host``, ``path``, ``rule``, ``verdict`` and ``score``.

    ``score`` is the model's log odds of "block"; without a fitting rule above 0 means
    block. A NULL url or one without ``://`` has an empty host and path and is
    allowed. Words and labels of any length count. Repeated rows give repeated results; columns of these
    names are replaced; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    urls = pages.select(host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    # Each host is segmented once, however many urls it has.
    hosts = stage(segment_hosts(urls.select("host").distinct(), stage(word_counts(pages, url_col, html_col))))
    odds_of, prior = _count_cells(urls.distinct().join(hosts, "host"), frozenset(seeds))
    odds = spark.sparkContext.broadcast(odds_of)

    def score_hosts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["host"]].assign(host_score=[float(sum(odds.value[_cell(w)] for w in words)) for words in batch["words"]])

    scored = hosts.mapInPandas(score_hosts, "host string, host_score double").withColumnRenamed("host", "_host")
    made = ("host", "path", "rule", "verdict", "score")
    kept = [c for c in pages.columns if c not in made and c != html_col]
    judged = pages.select(*kept).withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col)))
    joined = judged.join(stage(scored), F.col("host") == F.col("_host"), "left").drop("_host")

    def add_paths(hosts_: list[float | None], paths: list[str]) -> list[list]:
        return [[(h or 0.0) + sum(float(odds.value[_cell(w)]) for w in path_words(p)) + prior for h, p in zip(hosts_, paths, strict=True)]]

    rule = rule_for(F.col("host"), F.col("path"), rules)
    blocked = (F.col("host") != "") & (F.col("score") > 0)
    return (
        computed(joined, ["host_score", "path"], add_paths, [T.StructField("score", T.DoubleType())], ["host_score"])
        .withColumn("_fit", rule)
        .withColumn("rule", F.col("_fit.rule"))
        .withColumn("verdict", F.coalesce(F.col("_fit.verdict"), F.when(blocked, "block").otherwise("allow")))
        .select(*kept, *made)
    )


def hidden_seeds(
    pages: DataFrame, url_col: str = "url", html_col: str | None = "html", seeds: Sequence[str] = tuple(SEEDS)
) -> DataFrame:
    """(bad, hosts, blocked): what the model makes of hosts it has not seen, without their seed words.

    The model counts the urls of half of the hosts; the other half is scored by its hosts' words without seeds.
    """
    spark, marks = pages.sparkSession, frozenset(seeds)
    urls = pages.select(host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")).distinct()
    hosts = stage(segment_hosts(urls.select("host").distinct(), stage(word_counts(pages, url_col, html_col))))
    learn = F.crc32("host") % 2 == 0
    odds_of, prior = _count_cells(urls.where(learn).join(hosts, "host"), marks)
    odds = spark.sparkContext.broadcast(odds_of)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sum(float(odds.value[_cell(w)]) for w in words if w not in marks) + prior for words in batch["words"]]
            yield pd.DataFrame({"bad": [not marks.isdisjoint(w) for w in batch["words"]], "score": found})

    scored = hosts.where(~learn).mapInPandas(score, "bad boolean, score double")
    return scored.groupBy("bad").agg(F.count(F.lit(1)).alias("hosts"), F.count_if(F.col("score") > 0).alias("blocked"))
