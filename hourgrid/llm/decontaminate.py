"""Benchmark questions inside documents, also with other numbers, names and units.

1. Texts become templates: numbers, names (capitalised words inside a
   sentence; a run of them is one) and units after a number are replaced by typed
   placeholders, everything else is lower-cased. A capitalised word that starts a
   sentence is read both ways, as a word and as a name.
2. Every window of ``WINDOW`` template words is hashed. Windows of documents
   pass a fixed-size filter of the benchmark's windows, and what passes is joined
   to the benchmark's windows by hash.
3. Matches are added up per document, item and offset. An offset counts only if
   its slots are consistent: one value of the item always stands for the same
   value in the document. A sentence start that breaks this is read as a word.
   Windows with fewer than ``LITERALS`` literal words match only word for word, with
   equal values; an item under ``WINDOW`` template words is one window.
4. A document is contaminated by an item when the consistent windows cover at
   least ``min_coverage`` of the item's windows with enough literal words, or of all,
   or ``EXCERPT`` of its words in a row at one offset.

Nothing of document size leaves the tasks; matched windows per (document, item,
offset) are at most the item's length.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from dataclasses import fields as dataclass_fields

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hourgrid.llm import bloom
from hourgrid.llm.frames import Remembered, stage

WINDOW = 8
LITERALS = 4
SHORTEST = 3
MIN_COVERAGE = 0.5
EXCERPT = 50
# A window is followed up only if the benchmark has one with the same first words, so many of them.
PREFIXES = (2, 4)
CACHE = 150_000
CHUNK = 1 << 21

# Number words and units.
NUMBER_WORDS = frozenset(
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen".split()
)
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres mg g kg gram grams kilogram "
    "kilograms ounce ounces pound pounds lb lbs ton tons tonne tonnes ml l liter liters litre litres gallon gallons "
    "second seconds minute minutes hour hours day days week weeks month months year years cent cents dollar dollars "
    "euro euros percent degree degrees mph kmh watt watts volt volts byte bytes".split()
)

_TOKEN = re.compile(r"\d(?:[\d.,]*\d)?|[^\W\d_]+|[.!?\n:]")
_LOWER, _CAPITAL, _NUMBER, _UNIT, _MARK = range(5)  # four bits of a code hold these and _STRANGE
_PLACEHOLDER = {k: np.uint64(xxhash.xxh64_intdigest(f"<{k}>")) for k in (_CAPITAL, _NUMBER, _UNIT)}
_FACTOR = np.uint64(0x100000001B3)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class _Codes:
    """The codes of the tokens of texts, eight bytes each.

    A code is the hash of the lower-cased token without its last 4 bits, a bit for
    words that the benchmark lacks, as ``bits`` says, and the kind.
    """

    def __init__(self, bits: np.ndarray | None = None) -> None:
        self.bits = bits
        self.holds = bloom.single(bits) if bits is not None else None
        self.tokens, self.chunks = Remembered(self._token, CACHE), Remembered(self._chunk, CACHE)

    def _token(self, token: str) -> bytes:
        low, first = token.lower(), token[0]
        if first in ".!?\n:":
            kind = _MARK
        elif first.isdigit() or low in NUMBER_WORDS:
            kind = _NUMBER
        elif low in UNITS:
            kind = _UNIT
        else:
            kind = _CAPITAL if first.isupper() else _LOWER
        code = xxhash.xxh64_intdigest(low.encode("utf-8", "surrogatepass")) & ~15
        if self.holds is not None and not self.holds(code):
            code |= _STRANGE
        return (code | kind).to_bytes(8, "little")

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self.tokens[chunk]
        return b"".join(map(self.tokens.__getitem__, _TOKEN.findall(chunk)))

    def of_text(self, text: str) -> bytes:
        """A text begins like a line; no token holds a blank."""
        return b"".join(map(self.chunks.__getitem__, ["\n", *text.replace("\n", " \n ").split(" ")]))


_STRANGE = 8
_codes: dict[int, _Codes] = {}


def _codes_for(bits: np.ndarray | None) -> _Codes:
    """The token codes for one filter, kept in the worker during a task."""
    key = id(bits)
    if key not in _codes or _codes[key].bits is not bits:
        _codes.clear()
        _codes[key] = _Codes(bits)
    return _codes[key]


@dataclass
class Template:
    """One entry per template word: hash, whether it is a slot, the hash of what stood there, and the text's number.

    ``soft``: a capitalised word at a sentence start, a literal here, that may be a
    name. ``joined``: a name right behind such a word, the same name if that is one.
    ``strange``: a word that the benchmark does not have, as the filter says.
    """

    hashed: np.ndarray
    slot: np.ndarray
    values: np.ndarray
    soft: np.ndarray
    joined: np.ndarray
    number: np.ndarray
    strange: np.ndarray


def template(*texts: str, bits: np.ndarray | None = None) -> Template:
    """The template of texts, one behind the other."""
    listed = list(map(_codes_for(bits).of_text, texts))
    number = np.repeat(np.arange(len(listed), dtype=np.int32), np.fromiter(map(len, listed), np.int64, len(listed)) >> 3)
    codes = np.frombuffer(b"".join(listed), "<u8").astype(np.uint64)
    kind = (codes & np.uint64(7)).astype(np.int8)
    words = kind != _MARK
    starts = np.concatenate([[True], ~words[:-1]])[words] if len(kind) else words
    codes, kind, number = codes[words], kind[words], number[words]
    strange = codes & np.uint64(_STRANGE) > 0
    codes &= ~np.uint64(15)
    capital, before = kind == _CAPITAL, np.zeros(len(kind), np.bool_)
    before[1:] = (kind[:-1] == _NUMBER) & (number[1:] == number[:-1])
    soft, name = capital & starts, capital & ~starts
    slot = name | ((kind == _UNIT) & before) | (kind == _NUMBER)
    strange &= ~slot
    hashed = codes.copy()
    places = np.array([0, _PLACEHOLDER[_CAPITAL], _PLACEHOLDER[_NUMBER], _PLACEHOLDER[_UNIT]], np.uint64)
    hashed[slot] = places[kind[slot]]
    joined = name.copy()
    joined[1:] &= soft[:-1]
    joined[:1] = False
    # A run of names is one slot that holds all of them.
    again = name.copy()
    again[1:] &= name[:-1]
    again[:1] = False
    if again.any():
        first = np.flatnonzero(~again)
        further = np.flatnonzero(again)
        group = np.searchsorted(first, further) - 1
        values = codes[first]
        np.add.at(values, group, codes[further] * _GOLDEN ** (further - first[group]).astype(np.uint64))
        return Template(hashed[first], slot[first], values, soft[first], joined[first], number[first], strange[first])
    return Template(hashed, slot, codes, soft, joined, number, strange)


_POWERS = np.array([pow(int(_FACTOR), k, 1 << 64) for k in range(WINDOW)], np.uint64)
_LITERAL, _SLOT, _SOFT = range(3)


def _mixed(total: np.ndarray) -> np.ndarray:
    total = (total ^ (total >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (total ^ (total >> np.uint64(29))).view(np.int64)


def _prefix(total: np.ndarray, length: int) -> np.ndarray:
    return _mixed(total + np.uint64(length * int(_GOLDEN) & 0xFFFF_FFFF_FFFF_FFFF))


@dataclass
class Readings:
    """Windows with one reading each of their sentence starts: begin, hash, kinds, values, end, and the hashes of their first words."""

    begin: np.ndarray
    hashes: np.ndarray
    kinds: np.ndarray
    held: np.ndarray
    end: np.ndarray
    prefixes: np.ndarray


def _walk(parts: Template, begin: np.ndarray, size: int, bits: np.ndarray | None) -> Readings:
    """All readings of the windows at ``begin`` that have enough literals; a start is read as a word and as a name.

    With ``bits`` a reading ends where the benchmark has no window that begins like it, or at a strange word.
    """
    last, width = len(parts.hashed) - 1, len(PREFIXES)
    at, own, row = begin, parts.number[begin], np.arange(len(begin))
    total, slots = np.full(len(begin), size, np.uint64), np.zeros(len(begin), np.int64)
    kinds, held = np.zeros((len(begin), size), np.int8), np.zeros((len(begin), size), np.uint64)
    prefixes = np.zeros((len(begin), width), np.int64)

    for k in range(size):
        good = (at <= last) & (parts.number[np.minimum(at, last)] == own)
        soft = good & parts.soft[np.minimum(at, last)]
        if bits is not None:
            good &= ~parts.strange[np.minimum(at, last)]
        named = np.concatenate([np.zeros(int(good.sum()), bool), np.ones(int(soft.sum()), bool)])
        row = np.concatenate([np.flatnonzero(good), np.flatnonzero(soft)])
        begin, at, own, total, slots = begin[row], at[row], own[row], total[row], slots[row]
        kinds, held, prefixes = kinds[row], held[row], prefixes[row]
        follows = np.minimum(at + 1, last)
        run = named & (at < last) & parts.joined[follows]
        # A start with names behind it has the value that a run of all these names has inside a sentence.
        held[:, k] = np.where(run, parts.values[at] + parts.values[follows] * _GOLDEN, parts.values[at])
        kinds[:, k] = np.where(named, _SOFT, np.where(parts.slot[at], _SLOT, _LITERAL))
        slots = slots + (kinds[:, k] != _LITERAL)
        total = total + np.where(named, _PLACEHOLDER[_CAPITAL], parts.hashed[at]) * _POWERS[k]
        at = at + 1 + run
        keep = slots <= size - LITERALS
        if k + 1 in PREFIXES and k + 1 < size:
            prefixes[:, PREFIXES.index(k + 1)] = key = _prefix(total, k + 1)
            if bits is not None:
                keep &= bloom.contains(bits, key)
        begin, at, own, total, slots = begin[keep], at[keep], own[keep], total[keep], slots[keep]
        kinds, held, prefixes = kinds[keep], held[keep], prefixes[keep]
    return Readings(begin, _mixed(total), kinds, held, at, prefixes)


def _running(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each place."""
    return np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])


def _cut(parts: Template, size: int, bits: np.ndarray | None, whole: bool) -> list[Readings]:
    """The windows of ``size`` words, of those that are a ``whole`` text if asked for.

    A window over a strange word matches nothing, whatever else is in it; only
    a strange sentence start may still be a name. Such windows are never hashed.
    """
    number, found = parts.number, []
    count = max(0, len(parts.hashed) - size + 1)
    if not count:
        return found
    hard, odd = _running(parts.strange & ~parts.soft), _running(parts.strange & parts.soft)
    places = np.flatnonzero((number[:count] == number[size - 1 :]) & (hard[size:] == hard[:-size]))
    names = odd[places + size] - odd[places]
    filled = _running(~parts.slot)
    few = places[(names == 0) & (filled[places + size] - filled[places] < LITERALS)]
    # Windows with few literal words match only with the same values: nothing is a slot there.
    total = np.full(len(few), _GOLDEN + np.uint64(size), np.uint64)
    for k in range(size):
        total += parts.values[few + k] * _POWERS[k]
    there = few[:, None] + np.arange(size)
    none = np.zeros((len(few), len(PREFIXES)), np.int64)
    found.append(Readings(few, _mixed(total), np.zeros(there.shape, np.int8), parts.values[there], few + size, none))
    found.append(_walk(parts, places[names <= size - LITERALS], size, bits))

    def keep(r: Readings) -> Readings:
        good = np.ones(len(r.begin), bool)
        if whole:
            good &= (r.begin == np.searchsorted(number, number[r.begin])) & (r.end == np.searchsorted(number, number[r.begin], "right"))
        if bits is not None:
            good &= bloom.contains(bits, r.hashes)
        return Readings(*(getattr(r, f.name)[good] for f in dataclass_fields(r)))

    return [keep(r) for r in found]


def windows(
    *texts: str, bits: np.ndarray | None = None, sizes: Iterable[int] = (WINDOW,), whole: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, spot, eligible windows, all windows, is eligible, words), hash, kinds, values and first words' hashes.

    A window is eligible with enough literal words; the others match only with equal
    values. Every capitalised sentence start is read both as a word and as a name, so
    one place gives one window per reading of the starts in it. ``spot`` counts a
    start and the names behind it once, and is odd in such names. ``sizes`` lists the
    words per window; with ``whole`` those under ``WINDOW`` must be all of a text.
    With ``bits`` only windows that pass the filter.
    """
    parts = template(*texts, bits=bits)
    number, step = parts.number, np.cumsum(~parts.joined) - 1
    found: list[tuple[np.ndarray, ...]] = []
    for size in sizes:
        for r in _cut(parts, size, bits, whole and size < WINDOW):
            if len(r.begin):
                room = ((0, 0), (0, WINDOW - size))
                found.append((r.begin, r.hashes, np.pad(r.kinds, room), np.pad(r.held, room), r.prefixes, np.full(len(r.begin), size)))
    if not found:
        nothing = np.zeros((0, WINDOW), np.int8)
        return np.zeros((0, 7), np.int64), np.zeros(0, np.int64), nothing, nothing.astype(np.uint64), np.zeros((0, len(PREFIXES)), np.int64)
    begin, hashes, kinds, held, prefixes, size = (np.concatenate(column) for column in zip(*found, strict=True))
    count = max(0, len(number) - WINDOW + 1)
    places = np.flatnonzero(number[:count] == number[len(number) - count :])
    filled = _running(~parts.slot)
    eligible = np.zeros(len(number), bool)
    eligible[places] = (filled[places + WINDOW] - filled[places]) >= LITERALS
    n, every = np.bincount(number[eligible], minlength=len(texts)), np.bincount(number[places], minlength=len(texts))
    base, text = np.searchsorted(number, number[begin]), number[begin]
    spot = 2 * (step[begin] - step[base]) + parts.joined[begin]
    where = np.stack([text, begin - base, spot, n[text], every[text], eligible[begin], size], axis=1)
    return where.astype(np.int64), hashes, kinds, held, prefixes


_PLACED = ("place", "spot", "n", "every", "eligible", "size", "hash")
_SLOTS = (T.StructField("slots", T.ArrayType(T.LongType())), T.StructField("soft", T.ArrayType(T.BooleanType())))
_BEGINNINGS = tuple(T.StructField(f"first{k}", T.LongType()) for k in PREFIXES)


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK`` characters together, which are cut into windows at once."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= CHUNK or i + 1 == len(texts):
            yield begin, i + 1
            begin, size = i + 1, 0


def _windows_of(texts: DataFrame, bits: Broadcast | None, sizes: list[int], whole: bool) -> DataFrame:
    """One row per window of ``texts`` (key, text), of those that pass the filter if there is one.

    ``text_key`` stands for the text itself, so different texts under one key are told apart.
    """
    key = texts.schema["key"]
    layout = T.StructType([key, T.StructField("text_key", T.LongType()), *(T.StructField(c, T.LongType()) for c in _PLACED), *_SLOTS, *_BEGINNINGS])
    schema = to_arrow_schema(layout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column("key").cast(schema.field("key").type), batch.column("text").to_pylist()
            for begin, end in _chunks(texts):
                filled = bits.value if bits is not None else None
                where, hashes, kinds, held, prefixes = windows(*texts[begin:end], bits=filled, sizes=sizes, whole=whole)
                if not len(hashes):
                    continue
                there = kinds != _LITERAL
                offsets = np.concatenate([[0], np.cumsum(there.sum(axis=1))]).astype(np.int32)
                row, which = np.unique(where[:, 0], return_inverse=True)
                text_keys = np.array([xxhash.xxh64_intdigest(texts[begin + r]) for r in row.tolist()], np.uint64).view(np.int64)
                columns = [
                    keys.take(pa.array(begin + where[:, 0])),
                    pa.array(text_keys[which]),
                    *(pa.array(column) for column in where.T[1:]),
                    pa.array(hashes),
                    pa.ListArray.from_arrays(offsets, pa.array(held[there].view(np.int64))),
                    pa.ListArray.from_arrays(offsets, pa.array((kinds == _SOFT)[there])),
                    *(pa.array(column) for column in prefixes.T),
                ]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        _codes.clear()  # the worker's next task may be another operator's, which needs the memory

    return texts.where("text IS NOT NULL").mapInArrow(run, layout)


def _words_of(texts: DataFrame) -> DataFrame:
    """The distinct template words of ``texts`` (key, text), as ``hash``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = template(*batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(parts.hashed[~parts.slot]).view(np.int64))], ["hash"])

    return texts.where("text IS NOT NULL").mapInArrow(run, "hash long").distinct()


def _keys_of(known: DataFrame) -> DataFrame:
    """The hashes of the windows and of their first words, as ``hash``."""
    return known.select(F.explode(F.array("hash", *[f.name for f in _BEGINNINGS])).alias("hash"))


# A hit: place in the item, eligible, words, and per slot the item's value, the text's, and whether it is a soft reading.
Hit = tuple[int, int, int, tuple[int, ...], tuple[int, ...], tuple[bool, ...]]


def accepted(hits: list[Hit]) -> list[Hit]:
    """The hits of one text, item and offset that count.

    The windows without a start read as a name count if their slots are
    consistent. Further windows count if those are consistent with all that remain; a
    start that would stand for two values is no name, and its windows are left out.
    """

    def values(of: list[Hit]) -> dict[int, set[int]]:
        found: dict[int, set[int]] = {}
        for hit in of:
            for theirs, own in zip(hit[3], hit[4], strict=True):
                found.setdefault(theirs, set()).add(own)
        return found

    twice = {theirs for theirs, own in values(hits).items() if len(own) > 1}
    if not twice:
        return hits
    plain = [h for h in hits if not any(h[5])]
    clear = [h for h in hits if not any(soft and theirs in twice for theirs, soft in zip(h[3], h[5], strict=True))]
    kept = [part for part in (plain, clear) if all(len(own) == 1 for own in values(part).values())]
    return list({h: None for part in kept for h in part})


def _longest(places: list[int]) -> int:
    """The most words of the item in a row that lie in windows at the sorted places."""
    begin = last = None
    best = 0
    for place in places:
        if last is None or place - last > WINDOW:
            begin = place
        last = place
        best = max(best, place + WINDOW - begin)
    return best


_GROUP = ("doc", "text_key", "item", "item_key", "n", "every")


def _judged(matched: DataFrame) -> DataFrame:
    """Per text, item and offset: the accepted places, whether each is eligible, and what else the coverage needs.

    A group holds the matches of one item at one place of one text: at most the item's words times the
    readings of the starts in a window.
    """
    soft = F.transform(F.arrays_zip(F.col("soft").alias("a"), F.col("own_soft").alias("b")), lambda p: p["a"] | p["b"])
    hit = F.struct(F.col("item_at").alias("place"), "eligible", "size", "slots", "own", soft.alias("soft"))
    grouped = matched.groupBy(*_GROUP, (F.col("at") - F.col("item_spot")).alias("offset")).agg(F.collect_set(hit).alias("hits"))
    kept = [f for f in grouped.schema.fields if f.name in _GROUP]
    fields = [
        T.StructField("places", T.ArrayType(T.LongType())),
        T.StructField("open", T.ArrayType(T.BooleanType())),
        T.StructField("whole", T.BooleanType()),
        T.StructField("run", T.LongType()),
        T.StructField("changed", T.BooleanType()),
    ]
    layout = T.StructType([*kept, *fields])
    schema = to_arrow_schema(layout)

    def judge(hits: list[dict]) -> tuple:
        listed = [(h["place"], h["eligible"], h["size"], tuple(h["slots"]), tuple(h["own"]), tuple(h["soft"])) for h in hits]
        good = accepted(listed)
        places = sorted({(h[0], h[1] == 1) for h in good})
        changed = any(theirs != own for h in good for theirs, own in zip(h[3], h[4], strict=True))
        at = [p for p, _ in places]
        return at, [e for _, e in places], any(h[2] < WINDOW for h in good), _longest(at), changed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [judge(hits) for hits in batch.column("hits").to_pylist()]
            if not made:
                continue
            columns = [batch.column(f.name).cast(schema.field(f.name).type) for f in kept]
            columns += [pa.array(c, schema.field(f.name).type) for c, f in zip(zip(*made, strict=True), fields, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return grouped.select(*[f.name for f in kept], "hits").mapInArrow(run, layout).where("size(places) > 0")


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """(id, item, windows, covered, coverage, reparameterised), one row per contaminated document and item.

    ``reparameterised``: some slot holds another value than in the item. Defined
    cases: NULL and empty texts have no windows and are never contaminated, items
    of fewer than ``WINDOW`` template words match as a whole and those of fewer than ``SHORTEST``
    contaminate nothing; of rows that share an id each text is judged, the best covered one is
    reported; ids of any type, NULLs too; copies are judged alike; further columns are ignored; an
    empty table on either side gives an empty result.
    """
    spark = docs.sparkSession

    items = benchmark.select(F.col(item_col).alias("key"), F.col(item_text_col).alias("text"))
    known = stage(_windows_of(items, None, list(range(SHORTEST, WINDOW + 1)), True))
    bits = spark.sparkContext.broadcast(bloom.build(_keys_of(known).unionByName(_words_of(items)), "hash"))
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    sizes = sorted({WINDOW, *(r["size"] for r in known.select("size").distinct().collect())})  # at most WINDOW numbers
    hits = _windows_of(texts, bits, sizes, False)
    matched = hits.select(
        F.col("key").alias("doc"), "text_key", F.col("spot").alias("at"), "hash", F.col("slots").alias("own"), F.col("soft").alias("own_soft")
    ).join(
        known.select(
            F.col("key").alias("item"), F.col("text_key").alias("item_key"), F.col("place").alias("item_at"),
            F.col("spot").alias("item_spot"), "hash", "slots", "soft", "n", "every", "eligible", "size",
        ),
        "hash",
    )
    covered = (
        _judged(matched)
        .select(*_GROUP, "whole", "run", "changed", F.explode(F.arrays_zip("places", "open")).alias("hit"))
        .groupBy(*_GROUP)
        .agg(
            F.count_distinct(F.when(F.col("hit.open"), F.col("hit.places"))).alias("open"),
            F.count_distinct("hit.places").alias("covered"),
            F.max("whole").alias("whole"),
            F.max("run").alias("run"),
            F.max("changed").alias("reparameterised"),
        )
    )
    # An item that matched as one short window is covered; else the better share of eligible or of all windows counts.
    both = F.greatest("every", F.lit(1).cast("long"))
    share = F.when(F.col("n") > 0, F.col("open") / F.col("n")).otherwise(F.lit(0.0))
    better = F.when(F.col("whole"), F.struct(both.alias("windows"), both.alias("covered"))).when(
        share >= F.col("covered") / both, F.struct(F.col("n").alias("windows"), F.col("open").alias("covered"))
    ).otherwise(F.struct(F.col("every").alias("windows"), F.col("covered")))
    leaks = covered.select("doc", "item", "reparameterised", "run", better.alias("b")).withColumn("coverage", F.col("b.covered") / F.col("b.windows"))
    # Of several texts under one id, and several under one item, the pair that is covered best.
    best = (
        leaks.where((F.col("coverage") >= min_coverage) | (F.col("run") >= EXCERPT))
        .groupBy("doc", "item")
        .agg(F.max(F.struct("coverage", "b.windows", "b.covered", "reparameterised")).alias("best"))
    )
    return best.select(
        F.col("doc").alias(id_col), F.col("item").alias(item_col), "best.windows", "best.covered", "best.coverage", "best.reparameterised"
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated documents; same columns."""
    id_col = options.get("id_col", "doc_id")
    leaked = find_leaks(docs, benchmark, **options).select(F.col(id_col).alias("__leaked")).distinct()
    return docs.join(stage(leaked), F.col(id_col).eqNullSafe(F.col("__leaked")), "left_anti")
