"""Best-fit packing of token sequences with a bounded number of open bins.

Online best-fit: a piece goes to the open bin with the least free space that still holds it. Open bins are
kept in a bitset keyed by free space (bit f set: some open bin has f free), so the bin is found by a shift and
a lowest-set-bit step. Of the fixed number of open bins the fullest closes first when another is needed.

Tasks tokenize and pack what they read, without moving texts. The bins that are open when a task ends are not
wasted: their pieces, a bounded number a task, are packed once more with those of other tasks, longest first.

Defined cases: a null or empty text is one piece that holds the end id alone; texts longer than the capacity
are cut whatever their length, the first piece being the shorter one; repeated rows and doc_ids are packed as rows of their
own; of several bins with the same free space the one that came to it last is taken, and pieces of equal length are
packed once more in the order of doc_id, piece and sequence; a null doc_id stays null; an empty table gives no row; columns other
than doc_id and text are never read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelforge.llm.common import blocks, cut

CAPACITY = 1024
OPEN_BINS = 256
END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, open boolean"


class Encoder:
    """Ids of a byte-level BPE vocabulary (a JSON file of the tokenizers library) as little-endian unsigned 32-bit bytes.

    A text is first cut at the added tokens of the file, which have one id wherever they stand. Byte-level BPE never joins
    what stands on either side of a single space between two other characters, so the rest is cut there too, and a memo
    of at most `most` chunks serves most of it. Chunks are encoded over the file's merge ranks by tiktoken, in less than half
    of the library's time; tests hold the ids against the library with its default settings. A file with another kind of
    pretokens or added tokens that strip white space is refused.
    """

    ODD = re.compile(r"[\s\x1c-\x1f\x85]{2}|[\s\x1c-\x1f\x85]\Z")
    CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85]) (?=[^\s\x1c-\x1f\x85])")

    def __init__(self, path: str, most: int = 300_000):
        import json

        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        added, before = file["added_tokens"], file["pre_tokenizer"] or {}
        if file["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{path}: not a plain byte-level vocabulary")
        self._added = {t["content"]: int(t["id"]).to_bytes(4, "little") for t in added}
        self._at_added = re.compile("(" + "|".join(re.escape(t) for t in sorted(self._added, key=len, reverse=True)) + ")") if added else None
        byte = {c: b for b, c in enumerate(byte_names())}
        ranks = {bytes(map(byte.__getitem__, token)): rank for token, rank in file["model"]["vocab"].items() if token not in self._added}
        self._bpe = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        plain = self.plain

        class Memo(dict):
            before = ""

            def __missing__(self, part: str) -> bytes:
                ids = plain(self.before + part)
                if len(part) <= 64:
                    if len(self) >= most:
                        self.clear()
                    self[part] = ids
                return ids

        class Spaced(Memo):
            before = " "

        self._head, self._rest = Memo().__getitem__, Spaced().__getitem__

    def plain(self, text: str) -> bytes:
        return array("I", self._bpe.encode_ordinary(text)).tobytes()

    def __call__(self, text: str) -> bytes:
        if self._at_added is None or not any(map(text.__contains__, self._added)):
            return self._chunks(text)
        return b"".join([self._added.get(part) or self._chunks(part) for part in self._at_added.split(text)])

    def _chunks(self, text: str) -> bytes:
        if not text:
            return b""
        head, *rest = self.CUT.split(text) if self.ODD.search(text) else text.split(" ")
        return (self._head(head) if head else b"") + b"".join(map(self._rest, rest))


def byte_names() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if it prints, else the next one from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in prints else next(others)) for b in range(256)]


class OpenBins:
    """A fixed number of open bins; put() gives the bin of a piece, and the bins that had to close."""

    def __init__(self, capacity: int = CAPACITY, bins: int = OPEN_BINS):
        self.capacity, self.most, self.count, self.bits, self.next = capacity, bins, 0, 0, 0
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by free space

    def _pop(self, free: int) -> int:
        held = self.at[free]
        number = held.pop()
        if not held:
            self.bits &= ~(1 << free)
        return number

    def put(self, length: int) -> tuple[int, int, int | None]:
        """(bin, offset in it, the bin that closed or None); a full bin closes at once."""
        if length == self.capacity:  # fills a bin of its own, which never opens
            self.next += 1
            return self.next - 1, 0, None
        closed = None
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._pop(free)
        else:
            if self.count == self.most:
                closed = self._pop((self.bits & -self.bits).bit_length() - 1)  # the fullest
                self.count -= 1
            free, number = self.capacity, self.next
            self.next += 1
            self.count += 1
        left = free - length
        if left:
            self.at[left].append(number)
            self.bits |= 1 << left
        else:
            self.count -= 1
        return number, self.capacity - free, closed

    def open(self) -> set[int]:
        return {b for held in self.at for b in held}


def pieces_of(ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of each piece of a document's ids, in 4-byte units."""
    n = len(ids) // 4
    first = n % capacity or min(n, capacity)
    cuts = [0, *range(first, n + 1, capacity)]
    return [(a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for a, b in zip(cuts, cuts[1:], strict=False)]


def _packer(encoder: Callable[[], Callable[[str], bytes]], capacity: int, bins: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, state, end = encoder(), OpenBins(capacity, bins), end_id.to_bytes(4, "little")
        base = (TaskContext.get().partitionId() + 1) << 40
        waiting: dict[int, list[tuple]] = {}  # rows of bins that are still open: at most bins x capacity

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.bool_()]
            cols = zip(*rows, strict=True) if rows else [[] for _ in kinds]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in PIECES.split(", ")])

        for part in blocks(batches):
            out: list[tuple] = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                for k, (start, length, crc) in enumerate(pieces_of(encode(text or "") + end, capacity)):
                    number, offset, closed = state.put(length)
                    if closed is not None:
                        out += waiting.pop(closed)
                    row = (doc_id, k, start, length, crc, base + number, offset, False)
                    if offset + length == capacity:
                        out += waiting.pop(number, [])
                        out.append(row)
                    else:
                        waiting.setdefault(number, []).append(row)
            if out:
                yield batch(out)
        if waiting:
            yield batch([(*r[:-1], True) for rows in waiting.values() for r in rows])

    return run


def _repacker(capacity: int, bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, base = OpenBins(capacity, bins), ((TaskContext.get().partitionId() + 1) << 40) + (1 << 39)
        for part in batches:
            placed = [state.put(n)[:2] for n in part.column("length").to_pylist()]
            cols = [part.column(i) for i in range(5)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([base + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64()), pa.array([False] * len(placed))], part.schema.names)

    return run


def pack(docs: DataFrame, encoder: Callable[[], Callable[[str], bytes]], capacity: int = CAPACITY, bins: int = OPEN_BINS, end_id: int = END_ID, tasks_a_repack: int = 64) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    encoder() is called once per task and gives a function from text to little-endian 32-bit id bytes.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    first = cut(texts.mapInArrow(_packer(encoder, capacity, bins, end_id), PIECES))
    tasks = max(1, -(-first.rdd.getNumPartitions() // tasks_a_repack))
    again = (
        first.where("open").repartition(tasks, "sequence_id")
        .sortWithinPartitions(F.desc("length"), "doc_id", "piece", "sequence_id")
        .mapInArrow(_repacker(capacity, max(bins, capacity)), PIECES)
    )
    return first.where("not open").union(again).drop("open")
