"""Byte-pair encoding of whole texts with a public vocabulary, and decoding.

A text is cut at the vocabulary's special strings, normalised and cut into words
as the vocabulary file says. A word is a doubly linked list of symbols; a priority
queue holds the merge ranks of neighbouring symbols, the lowest first and leftmost
among equals. An entry whose symbols have changed since it was queued is stale and
skipped. Decoding concatenates the vocabulary's strings.

The vocabulary is read once, on the driver, and sent to the tasks: its size is that
of the file and is checked. Texts stay in their rows; words met before are looked up
in a bounded table of each Python worker.
"""

from __future__ import annotations

import functools
import heapq
import json
import os
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hourgrid.llm.frames import Remembered

LARGEST_FILE = 64 << 20
# Words, and as many pieces between white space, whose ids a worker remembers, twice at most: some 110 MB each.
WORDS = 300_000
# Texts of a record batch that are encoded before a batch of results is handed on, in characters.
CHUNK = 4 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is one, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    return [chr(rest.get(b, b)) for b in range(256)]


# Capitals of Unicode 16 and 17, as (first, last, step, distance to the small letter).
YOUNG_CAPITALS = (
    (0x1C89, 0x1C89, 1, 1),
    (0xA7CB, 0xA7CB, 1, 0x264 - 0xA7CB),
    (0xA7CC, 0xA7CE, 2, 1),
    (0xA7D2, 0xA7D4, 2, 1),
    (0xA7DA, 0xA7DA, 1, 1),
    (0xA7DC, 0xA7DC, 1, 0x19B - 0xA7DC),
    (0x10D50, 0x10D65, 1, 0x20),
    (0x16EA0, 0x16EB8, 1, 0x1B),
)
_SMALL = {c: c + by for first, last, step, by in YOUNG_CAPITALS for c in range(first, last + 1, step)} | {ord("Σ"): "σ"}


def _lower(text: str) -> str:
    """Character by character: a capital sigma at a word's end is no special case."""
    return text.lower() if text.isascii() else text.translate(_SMALL).lower()


# Letters and digits of the pattern library's character table that are unassigned in the vocabulary
# library's (Unicode 16), in hexadecimal.
YOUNG_LETTERS = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 "
    "10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 "
    "16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 "
    "1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed "
    "1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)
_YOUNG = regex.compile("[" + "".join("-".join(f"\\U{int(c, 16):08x}" for c in r.split("-")) for r in YOUNG_LETTERS.split()) + "]")
UNASSIGNED = "\u0378"


def _words(pattern: regex.Pattern, text: str) -> list[str]:
    """The words of a text; characters of ``YOUNG_LETTERS`` are neither letters nor digits."""
    if text.isascii() or not _YOUNG.search(text):
        return pattern.findall(text)
    plain = _YOUNG.sub(UNASSIGNED, text)
    return [text[m.start() : m.end()] for m in pattern.finditer(plain)]


def _normalizer(spec: dict | None) -> Callable[[str], str] | None:
    """What the file's normalizer does to a chunk without white space; None if nothing."""
    if spec is None:
        return None
    kind = spec["type"]
    if kind == "Sequence":
        steps = [step for s in spec["normalizers"] if (step := _normalizer(s))]

        def all_steps(text: str) -> str:
            for step in steps:
                text = step(text)
            return text

        return all_steps
    if kind in ("NFC", "NFD", "NFKC", "NFKD"):
        return lambda text: unicodedata.normalize(kind, text)
    if kind == "Lowercase":
        return _lower
    if kind == "Replace" and spec["pattern"] == {"Regex": r"\s+"} and spec["content"].isspace():
        return None  # a chunk holds no white space
    if kind == "Replace" and "Regex" in spec["pattern"]:
        pattern = regex.compile(spec["pattern"]["Regex"])
        return lambda text: pattern.sub(spec["content"].replace("\\", r"\\"), text)
    raise ValueError(f"normalizer {kind} is not supported")


def _word_pattern(spec: dict) -> regex.Pattern:
    """The pattern of words of a split that keeps its matches, before the byte mapping."""
    steps = spec["pretokenizers"] if spec["type"] == "Sequence" else [spec]
    split, to_bytes = steps if len(steps) == 2 else ({}, {})
    kept = split.get("type") == "Split" and split["behavior"] == "Removed" and split["invert"]
    plain = to_bytes.get("type") == "ByteLevel" and not to_bytes["add_prefix_space"] and not to_bytes["use_regex"]
    if not (kept and plain):
        raise ValueError("only a split that keeps its matches, followed by the byte mapping, is supported")
    words = regex.compile(split["pattern"]["Regex"])
    spaces = regex.findall(r"\s", "".join(map(chr, range(0x3001))))
    if any(regex.search(r"\s", m.group()) for w in spaces for m in words.finditer(f"{w}a{w}B{w}1{w}.{w}'{w}")):
        raise ValueError("words that hold white space are not supported")
    return words


# White space of Python that is none of the pattern library.
_SEPARATORS, _SPACE = regex.compile("[\x1c-\x1f]"), regex.compile(r"\s+")


class Vocabulary:
    """Encoder and decoder of one vocabulary file (its content as bytes)."""

    def __init__(self, content: bytes) -> None:
        spec = json.loads(content)
        model = spec["model"]
        for option in ("dropout", "unk_token", "continuing_subword_prefix"):
            if model.get(option):
                raise ValueError(f"{option} is not supported")
        if spec.get("decoder"):
            raise ValueError("a decoder is not supported")
        self.ids: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with options are not supported")
        self.special = special
        self.strings = {i: s for s, i in (self.ids | special).items()}
        self.normalize = _normalizer(spec.get("normalizer")) or str
        self.words = _word_pattern(spec["pre_tokenizer"])
        longest = sorted(special, key=len, reverse=True)
        self.cut = regex.compile(f"({'|'.join(map(regex.escape, longest))})")
        symbols = byte_symbols()
        self.first = [self.ids.get(s) for s in symbols]
        self.last = [self.ids.get(s + self.end) for s in symbols]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self._pairs = [f"{a} {b}" for a, b in pairs]
        self.known_words, self.known_chunks = Remembered(self._word_bytes, WORDS), Remembered(self.encode_chunk, WORDS)

    @functools.cached_property
    def by_rank(self) -> list[tuple[int, int, int]]:
        """By rank: left, right and merged id."""
        pairs = (p.split(" ") for p in self._pairs)
        return [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in pairs]

    @functools.cached_property
    def ranks(self) -> dict[int, int]:
        """The rank of a pair of ids, looked up as one number."""
        return {left << 32 | right: rank for rank, (left, right, _) in enumerate(self.by_rank)}

    def _word_bytes(self, word: str) -> bytes:
        return array("i", self.encode_word(word)).tobytes()

    def encode_word(self, word: str) -> list[int]:
        """The ids of one word: merges by rank, leftmost first, over a doubly linked list of symbols."""
        raw = word.encode("utf-8", "replace")
        ids = [i for b in raw[:-1] if (i := self.first[b]) is not None]
        if (i := self.last[raw[-1]]) is not None:
            ids.append(i)
        count, ranks, by_rank = len(ids), self.ranks, self.by_rank
        if count < 2:
            return ids
        before, after = list(range(-1, count - 1)), [*range(1, count), -1]
        # A queue entry is a rank and the place of the left symbol; which symbols were meant follows from the rank.
        queue = [r << 32 | at for at in range(count - 1) if (r := ranks.get(ids[at] << 32 | ids[at + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            at = entry & 0xFFFF_FFFF
            left, right, made = by_rank[entry >> 32]
            next_ = after[at]
            if ids[at] != left or next_ < 0 or ids[next_] != right:
                continue  # stale: one of the two has been merged since
            ids[at], ids[next_] = made, -1
            after[at] = far = after[next_]
            if far >= 0:
                before[far] = at
                if (r := ranks.get(made << 32 | ids[far])) is not None:
                    heapq.heappush(queue, r << 32 | at)
            near = before[at]
            if near >= 0 and (r := ranks.get(ids[near] << 32 | made)) is not None:
                heapq.heappush(queue, r << 32 | near)
        return [i for i in ids if i >= 0]

    def encode_chunk(self, chunk: str) -> bytes:
        """The ids of a text between white space, four bytes each."""
        return b"".join(map(self.known_words.__getitem__, _words(self.words, self.normalize(chunk))))

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text; special strings in it are their own ids."""
        pieces = self.cut.split(text) if any(s in text for s in self.special) else [text]
        found: list[bytes] = []
        for piece in pieces:
            if piece in self.special:
                found.append(array("i", [self.special[piece]]).tobytes())
            else:
                # Words hold no white space and no normalisation reaches over it, so each chunk is taken by itself.
                chunks = piece.split() if not _SEPARATORS.search(piece) else _SPACE.split(piece)
                found.extend(map(self.known_chunks.__getitem__, chunks))
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The strings of known ids, a space between two; ids without a string are left out."""
        listed = ids.tolist()
        try:
            return " ".join(map(self.strings.__getitem__, listed))
        except KeyError:
            return " ".join(self.strings[i] for i in listed if i in self.strings)


_loaded: dict[int, Vocabulary] = {}


def _vocabulary(content: Broadcast) -> Vocabulary:
    """The vocabulary of a broadcast file, built once per Python worker."""
    key = hash(content.value)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(content.value)
    return _loaded[key]


def read_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """A vocabulary file of the driver, sent to the tasks; raises above ``LARGEST_FILE`` bytes or for unknown options."""
    if os.path.getsize(path) > LARGEST_FILE:
        raise ValueError(f"{path} is larger than {LARGEST_FILE} bytes")
    with open(path, "rb") as file:
        content = file.read()
    Vocabulary(content)
    return spark.sparkContext.broadcast(content)


def _pieces(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``CHUNK`` together, one row at least."""
    begin, size = 0, 0
    for row, length in enumerate(lengths.tolist()):
        if row > begin and size + length > CHUNK:
            yield begin, row
            begin, size = row, 0
        size += length
    if begin < len(lengths):
        yield begin, len(lengths)


def _added(df: DataFrame, source: str, name: str, kind: T.DataType, make: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """``df`` with one more column, computed from Arrow slices of ``source``; a column of that name is replaced."""
    kept = [f for f in df.schema.fields if f.name != name]
    schema = T.StructType([*kept, T.StructField(name, kind)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(source))
            lengths = column.value_lengths() if pa.types.is_list(column.type) else pa.compute.binary_length(column)
            for begin, end in _pieces(lengths.fill_null(0).to_numpy(zero_copy_only=False)):
                part = batch.slice(begin, end - begin)
                made = make(column.slice(begin, end - begin))
                columns = [part.column(part.schema.get_field_index(f.name)).cast(arrow.field(f.name).type) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, made.cast(arrow.field(name).type)], schema=arrow)

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, vocabulary: Broadcast, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids``, the token ids of the whole text.

    Defined cases: NULL and empty texts have no ids (an empty array); equal texts have equal
    ids; a lone surrogate counts as a question mark; a column that is already named ``ids``
    is replaced; every other column stays as it is; an empty table gives an empty table.
    """

    def make(texts: pa.Array) -> pa.Array:
        own = _vocabulary(vocabulary)
        found = [own.encode(t or "") for t in texts.to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in found], dtype=np.int64)]).astype(np.int32)
        return pa.ListArray.from_arrays(offsets, np.concatenate([*found, np.zeros(0, np.int32)]))

    return _added(docs, text_col, ids_col, T.ArrayType(T.IntegerType()), make)


def decode(encoded: DataFrame, vocabulary: Broadcast, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``decoded``, the vocabulary's strings of the ids.

    NULL and empty arrays give an empty text; NULL or unknown ids in an array give nothing.
    """

    def make(ids: pa.Array) -> pa.Array:
        own = _vocabulary(vocabulary)
        lengths, flat = ids.value_lengths().fill_null(0).to_numpy(), ids.flatten().fill_null(-1).to_numpy()
        ends = np.cumsum(lengths)
        return pa.array([own.decode(flat[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist())], pa.string())

    return _added(encoded, ids_col, text_col, T.StringType(), make)
