"""Byte-level BPE encoding and decoding with an automaton of frequent words."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.automaton import Lexicon, compile_words
from millrace.llm.merging import Merger
from millrace.llm.tables import fresh, settle

# Frequent words that are compiled; their number bounds what the driver and a broadcast hold.
LEXICON_WORDS = 60_000
# Different words that a task counts before it hands them on.
COUNTED_WORDS = 50_000
# Documents that are encoded together.
BATCH = 256
# Longer words, in bytes, are merged one by one and never compiled.
LONGEST_WORD = 64

# White space (the Unicode property), and the pattern that cuts words into
# the pieces that are merged on their own.
_SPACE = "\t-\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_PIECE = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
# The same for texts of Latin-1 characters, whose letters and numbers can be written out.
_LETTER = "".join(c for c in map(chr, range(256)) if unicodedata.category(c)[0] == "L")
_NUMBER = "".join(c for c in map(chr, range(256)) if unicodedata.category(c)[0] == "N")
_LATIN_SPACE = "\\t-\\r \\x85\\xa0"
_LATIN_PIECE = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_LATIN_SPACE}{_LETTER}{_NUMBER}]+|"
    rf"[{_LATIN_SPACE}]+(?![^{_LATIN_SPACE}])|[{_LATIN_SPACE}]+"
)


@dataclass(frozen=True)
class Vocabulary:
    """Ids of byte strings, the ranks of merges, and strings that are taken whole."""

    ids: dict[bytes, int]
    ranks: dict[tuple[int, int], tuple[int, int]]
    special: dict[str, int]


def load_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE file of the tokenizers library."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    byte = {c: b for b, c in _byte_letters().items()}
    special = {t["content"]: t["id"] for t in found["added_tokens"]}
    ids = {bytes(byte[c] for c in t): i for t, i in found["model"]["vocab"].items() if t not in special}
    ranks = {}
    for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in found["model"]["merges"]):
        left, right = bytes(byte[c] for c in a), bytes(byte[c] for c in b)
        ranks[ids[left], ids[right]] = (rank, ids[left + right])
    return Vocabulary(ids, ranks, special)


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in vocabulary files: itself where it is one."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(rest)}


def merge(piece: bytes, vocabulary: Vocabulary) -> list[int]:
    """Ids of a piece: the pair of the lowest rank is merged, the leftmost first, until none is left."""
    ids, ranks = vocabulary.ids, vocabulary.ranks
    if piece in ids and len(piece) == 1:
        return [ids[piece]]
    parts = [ids[piece[i : i + 1]] for i in range(len(piece))]
    if len(parts) > LONGEST_WORD:
        return _merge_long(parts, ranks)
    get = ranks.get
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            found = get((parts[i], parts[i + 1]))
            if found is not None and (best is None or found < best):
                best, at = found, i
        if best is None:
            break
        parts[at : at + 2] = [best[1]]
    return parts


def _merge_long(parts: list[int], ranks: dict) -> list[int]:
    """The same with a heap and links, for pieces of any length."""
    n = len(parts)
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    heap = [(ranks[p][0], i, ranks[p][1], p) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, made, pair = heapq.heappop(heap)
        j = after[i] if parts[i] >= 0 else -1
        if j < 0 or (parts[i], parts[j]) != pair:
            continue
        parts[i], parts[j] = made, -1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right >= 0 and (parts[left], parts[right]) in ranks:
                rank, to = ranks[parts[left], parts[right]]
                heapq.heappush(heap, (rank, left, to, (parts[left], parts[right])))
    return [p for p in parts if p >= 0]


def cut(text: str) -> list[str]:
    """The pieces of a text that are merged on their own."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _PIECE.findall(text)
    return _LATIN_PIECE.findall(text)


class Codec:
    """Encodes and decodes whole texts, many at a time.

    Pieces that the automaton holds get their ids from it, all others are merged.
    """

    def __init__(self, vocabulary: Vocabulary, lexicon: bytes):
        self.vocabulary, self.lexicon = vocabulary, Lexicon(lexicon)
        self.bytes_of = {i: b for b, i in vocabulary.ids.items()} | {i: t.encode() for t, i in vocabulary.special.items()}
        single = [vocabulary.ids[bytes([b])] for b in range(256)]
        self.merger = Merger(single, vocabulary.ranks, 1 + max(self.bytes_of))
        self.special = re.compile("|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True))) or r"(?!)")
        # pieces of the automaton that were met: never more than it holds
        self.kept: dict[str, tuple[int, str, bytes]] = {}

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text, special strings among them."""
        if not any(s in text for s in self.vocabulary.special):
            return cut(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += cut(text[at : m.start()])
            out.append(m.group())
            at = m.end()
        return out + cut(text[at:])

    def table(self, pieces: set[str]) -> dict[str, tuple[int, str, bytes]]:
        """Per piece the number of its ids, the ids as text, and the bytes that they decode to."""
        special = self.vocabulary.special
        words = [p for p in pieces if p not in special]
        raw = [w.encode("utf-8", "replace") for w in words]
        ranks = self.lexicon.ranks(raw).tolist()
        unseen = [i for i, r in enumerate(ranks) if r < 0]
        short = [i for i in unseen if len(raw[i]) <= LONGEST_WORD]
        merged = dict(zip(short, self.merger([raw[i] for i in short])))
        out = {}
        for i, word in enumerate(words):
            if ranks[i] >= 0:
                out[word] = self.kept[word] = self._entry(self.lexicon.output(ranks[i]))
            else:
                out[word] = self._entry(merged[i] if i in merged else merge(raw[i], self.vocabulary))
        for piece in pieces & special.keys():
            out[piece] = self._entry([special[piece]])
        return out

    def _entry(self, ids: list[int]) -> tuple[int, str, bytes]:
        return len(ids), ",".join(map(str, ids)), self.decode(ids)

    def parts(self, texts: list[str | None]) -> Iterator[list[tuple[int, str, bytes]]]:
        """For each text what ``table`` tells of its pieces, in order."""
        cuts = [self.pieces(t or "") for t in texts]
        new = set().union(*cuts) - self.kept.keys()
        table = self.table(new)
        get, kept = table.get, self.kept
        for c in cuts:
            yield [get(p) or kept[p] for p in c]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [[int(i) for _, ids, _ in parts for i in ids.split(",")] for parts in self.parts(texts)]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of a sequence; ``.decode("utf-8", "replace")`` gives the text."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def digests(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """Number of ids, SHA-256 of the ids as text, SHA-256 of the decoded text."""
        for parts in self.parts(texts):
            ids = ",".join([p[1] for p in parts])
            decoded = b"".join([p[2] for p in parts])
            try:
                decoded.decode("utf-8")
            except UnicodeDecodeError:
                decoded = decoded.decode("utf-8", "replace").encode()
            yield sum([p[0] for p in parts]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()


def frequent_words(docs: DataFrame, text: str = "text", n: int = LEXICON_WORDS) -> list[str]:
    """The words that occur at least so often that there are no more than ``n`` of them.

    Counted in tasks first; a task that meets many words hands them on in several lots. The
    least count is found from the number of words of each count, a short table however
    many words there are, and only the words above it come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def lot() -> pa.RecordBatch:
            words = [w for w in counts if len(w.encode("utf-8", "replace")) <= LONGEST_WORD]
            columns = [pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for text_ in batch.column(0):
                counts.update(cut(text_.as_py() or ""))
                if len(counts) > COUNTED_WORDS:
                    yield lot()
                    counts.clear()
        yield lot()

    counted = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "word string, n bigint")
    # words that occur once are too many to write, and of no use to others
    counted = settle(counted.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1"))
    # counts are put together by their power of two from 4,096 on, so that there are few
    level = F.when(F.col("n") < 4096, F.col("n")).otherwise(F.pow(F.lit(2), F.floor(F.log2("n"))).cast("long"))
    levels = counted.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect()
    taken, least = 0, None
    for row in sorted(levels, key=lambda r: -r["level"]):
        taken += row["words"]
        if taken > n:
            break
        least = row["level"]
    if least is None:
        return []
    return sorted(r["word"] for r in counted.where(F.col("n") >= least).select("word").collect())


def build_lexicon(words: list[str], vocabulary: Vocabulary) -> bytes:
    raw = sorted({w.encode("utf-8", "replace") for w in words})
    return compile_words((w, merge(w, vocabulary)) for w in raw)


def encode_documents(docs: DataFrame, vocabulary_path: str, text: str = "text", lexicon_words: int = LEXICON_WORDS, keep_ids: bool = False) -> DataFrame:
    """The rows of ``docs`` with ``n_tokens, ids_sha256, decoded_sha256``, and ``ids`` if asked for.

    Ids are those of the tokenizers library without special tokens added: strings of special
    tokens in a text become their ids. ``ids_sha256`` is that of the decimal ids joined by
    commas, ``decoded_sha256`` that of the UTF-8 text decoded from the ids.

    The most frequent words of all texts, ``lexicon_words`` at most, are compiled with their
    ids into an automaton, a few MB that go to every executor; other words are merged exactly. The
    vocabulary is read on the driver, so the path need only be there.

    A null text is an empty one: no ids. Repeated rows are each encoded. Other columns stay as
    they are, except those of the names above, which are replaced.
    """
    vocabulary = load_vocabulary(vocabulary_path)
    lexicon = build_lexicon(frequent_words(docs, text, lexicon_words), vocabulary)
    shipped = docs.sparkSession.sparkContext.broadcast((vocabulary, lexicon))
    names = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids]
    kept = [c for c in docs.columns if c not in names]
    added = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    schema = T.StructType([*(f for f in docs.schema.fields if f.name in kept), *T.StructType.fromDDL(added).fields])
    column = fresh(docs.columns, "text")
    given = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").alias(column))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shipped)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                texts = part[column].to_pylist()
                digests = list(codec.digests(texts))
                arrays = [part[c] for c in kept]
                arrays += [pa.array(c, k) for c, k in zip(zip(*digests), (pa.int64(), pa.string(), pa.string()))]
                if keep_ids:
                    arrays.append(pa.array(codec.encode(texts), pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, [*kept, *names])

    return given.mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``encode_documents`` with nothing but the id and the digests."""
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return encode_documents(given, vocabulary_path).drop("text")


_CODECS: dict[int, Codec] = {}


def _codec(shipped) -> Codec:
    """One codec per worker process: its tasks share the words they have looked up."""
    key = id(shipped.value)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(*shipped.value)
    return _CODECS[key]


@lru_cache(maxsize=1)
def default_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))
