"""Exact substring dedup over merged Burrows-Wheeler transforms.

A byte goes if a string of WINDOW bytes covers it that also starts in a document with a smaller doc_id.

1. Texts are written once as blocks. Each window of WINDOW bytes is represented by its minimizer, the least hash
   of the GRAM-byte strings in it: equal windows have equal minimizers. Blocks send their distinct minimizers to
   ranges of hash values, which answer with one bit each: does another document have it too?
2. Maximal runs of windows with one such shared minimizer go, as strings and once per block with the least doc_id that has them
   there, to the minimizer's range. However often a passage occurs, a block sends it once, and its places never leave the block.
3. In a range, strings are laid into shards, and each shard gets its suffix order and Burrows-Wheeler transform. The
   transforms are merged by iterative interleave refinement: a round extends the common prefix of all rows by one symbol, each
   shard's rows being taken in the shard's own order, as counting over its transform gives it; suffixes are never
   sorted again. Blocks of the interleave whose rows come from one shard alone are settled and leave: what repeats in a shard is
   told by its own order. A block that is left after WINDOW rounds is an interval of several shards with a
   common prefix of WINDOW. The least doc_id in an interval is that of all its places.
4. Blocks are told where a window has a smaller doc_id elsewhere, apply it to all their places, and make the result.

Windows of different strings can be equal only under the same minimizer, so strings that are alone with theirs are not
laid into shards. Where a passage is so common that a minimizer of it has more than HOT_RUNS runs, with other text around it
in each, one range would get them all: there each window is sent as a string of its own, by its own hash. Blocks and ranges deal at most FAN rows each: with more ranges than that, rows are dealt to groups of ranges first,
put together there, and dealt on, so their number grows in proportion to the input.

Defined cases: null and empty texts are empty documents; texts under WINDOW bytes keep all; very long texts are one block
of their size, looked through in slices; a null doc_id comes after all others; rows with equal doc_id, repeated rows among
them, do not remove each other's bytes, and there are no other ties; an empty table gives no row; columns other than doc_id and
text are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelforge.llm.common import blocks, cut, strings

WINDOW, GRAM = 50, 24
BLOCK_BYTES = 8 << 20
#: Windows whose hashes are made at once.
SLICE = 1 << 20
RANGE_BYTES = 8 << 20
SHARD_BYTES = 1 << 18
#: Runs of one minimizer, some 65 bytes each, that a range takes as they are.
HOT_RUNS = 20_000
#: Most rows that a block, or a task that puts rows together, deals at once.
FAN = 1024
#: Bytes that such a task holds before it deals them on.
HELD_BYTES = 32 << 20
LAST = (1 << 63) - 1


# --- blocks -----------------------------------------------------------------------------------

_BLOCK_SCHEMA = "block long, n_bytes long, ids binary, nulls binary, sizes binary, data binary"


def _to_blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n, ids, texts, held = (TaskContext.get().partitionId() + 1) << 32, 0, [], [], 0

        def out():
            nonlocal n
            n += 1
            known = np.array([LAST if i is None else i for i in ids], "<i8")
            nulls = np.array([i is None for i in ids], np.uint8)
            sizes = np.array([len(t) for t in texts], "<i8")
            data = zstandard.ZstdCompressor(level=1).compress(b"".join(texts))
            cols = [[base + n], [int(sizes.sum())], [known.tobytes()], [nulls.tobytes()], [sizes.tobytes()], [data]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), *[pa.binary()] * 4), strict=True)], [c.split()[0] for c in _BLOCK_SCHEMA.split(", ")])

        for b in blocks(batches, size):
            for i, t in zip(b.column(0).to_pylist(), strings(b.column(1)), strict=True):
                if texts and held + len(t) > size:
                    yield out()
                    ids, texts, held = [], [], 0
                ids.append(i)
                texts.append(t)
                held += len(t)
        if texts:
            yield out()

    return run


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch one by one, for rows of a few MB each."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


class Block:
    """Texts of a block and, made when asked for, its runs of windows with one minimizer."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.ids, self.sizes = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["sizes"], "<i8")
        self.nulls = np.frombuffer(row["nulls"], np.uint8).astype(bool)
        self.data = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(1, row["n_bytes"]))
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(minimizer, first window, last window, document) of runs of windows with one minimizer, by place."""
        parts = [self._runs(lo, min(lo + SLICE, len(self.data) - WINDOW + 1)) for lo in range(0, len(self.data) - WINDOW + 1, SLICE)]
        if not parts:
            return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
        least, first, last = (np.concatenate([p[k] for p in parts]) for k in range(3))
        return least, first, last, np.searchsorted(self.starts, first, "right") - 1

    def _runs(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those of the windows lo to hi."""
        x, n, ends = np.frombuffer(self.data, np.uint8, hi - lo + WINDOW - 1, lo), hi - lo, self.starts + self.sizes
        low = _sliding_min(_grams(x), WINDOW - GRAM + 1)[:n]
        # windows that a document's end cuts
        near = slice(np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi + WINDOW))
        bad = np.zeros(n + 1, np.int32)
        np.add.at(bad, np.clip(np.maximum(self.starts[near], ends[near] - WINDOW + 1) - lo, 0, n), 1)
        np.add.at(bad, np.clip(ends[near] - lo, 0, n), -1)
        valid = np.cumsum(bad[:n]) == 0
        change = np.ones(n, bool)
        change[1:] = (low[1:] != low[:-1]) | ~valid[:-1]
        stop = np.ones(n, bool)
        stop[:-1] = change[1:] | ~valid[1:]
        first, last = np.flatnonzero(change & valid), np.flatnonzero(stop & valid)
        # least values crowd near zero: mixed again they fill all ranges alike
        least = low[first] * np.uint64(0xD6E8FEB86659FD93)
        least ^= least >> np.uint64(32)
        least *= np.uint64(0xD6E8FEB86659FD93)
        return least, first + lo, last + lo


def _grams(x: np.ndarray) -> np.ndarray:
    """64-bit hashes of all GRAM-byte strings, from those of 2, 4, 8 and 16 bytes."""
    m = 0x9E3779B97F4A7C15
    h, parts, size = x.astype(np.uint64) + np.uint64(1), {}, 1
    while size < GRAM:
        parts[size] = h
        add = max(k for k in parts if size + k <= GRAM)
        right = parts[add]
        factor = np.uint64(pow(m, add, 1 << 64))
        length = len(x) - size - add + 1
        h = h[:length] * factor + right[size : size + length]
        size += add
        parts = {k: v for k, v in parts.items() if k >= 8 or k == size}
    del parts
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size < width:
        add = min(size, width - size)
        h = np.minimum(h[: len(h) - add], h[add:])
        size += add
    return h


def _bounds(ranges: int) -> np.ndarray:
    """First hash value of each range but the first."""
    return np.array([-(-(k << 64) // ranges) for k in range(1, ranges)], np.uint64)


# --- dealing ------------------------------------------------------------------------------------

_DEALT = "p long, data binary"
Frame = tuple[int, int, bytes]  # range, block, content


def grains(n: int, fan: int) -> list[int]:
    """Buckets that successive dealings put together: each deals at most fan of them on, the last one single buckets."""
    out, g = [], n
    while not out or g > 1:
        g = -(-g // fan)
        out.append(g)
    return out


def _to_range(n: int, grain: int) -> Callable[[int, int], int]:
    return lambda p, block: p // grain


def _to_block(n: int, grain: int) -> Callable[[int, int], int]:
    """By blocks: n buckets of them by a hash of their number, and single blocks at last."""
    return lambda p, block: block if grain == 1 else (block * 0x9E3779B97F4A7C15 >> 20) % n // grain


def framed(frames: Iterable[Frame]) -> bytes:
    frames = list(frames)
    head = np.array([(p, b, len(x)) for p, b, x in frames], "<i8").reshape(-1, 3)
    return len(frames).to_bytes(8, "little") + head.tobytes() + b"".join([x for _, _, x in frames])


def frames_of(data: bytes) -> Iterator[Frame]:
    n = int.from_bytes(data[:8], "little")
    at = 8 + 24 * n
    for p, b, size in np.frombuffer(data, "<i8", 3 * n, 8).reshape(-1, 3).tolist():
        yield p, b, data[at : at + size]
        at += size


def _rows_by(key: Callable[[int, int], int], frames: Iterable[Frame]) -> pa.RecordBatch:
    held: dict[int, list[Frame]] = defaultdict(list)
    for f in frames:
        held[key(f[0], f[1])].append(f)
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([framed(x) for x in held.values()], pa.binary())], ["p", "data"])


def _deal_on(key: Callable[[int, int], int], most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Frame] = []
        size, p = 0, None
        for batch in batches:
            for at in range(batch.num_rows):
                now, data = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
                if held and (now != p or size + len(data) > most):
                    yield _rows_by(key, held)
                    held, size = [], 0
                p, size = now, size + len(data)
                held += frames_of(data)
        if held:
            yield _rows_by(key, held)

    return run


def dealt(rows: DataFrame, to: Callable, n: int, fan: int) -> DataFrame:
    """rows (p, data), dealt to groups of the first grain, in order of single buckets p."""
    for grain in grains(n, fan)[1:]:
        rows = rows.repartition("p").sortWithinPartitions("p").mapInArrow(_deal_on(to(n, grain), HELD_BYTES), _DEALT)
    return rows.repartition("p").sortWithinPartitions("p")


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[Frame]]]:
    """Frames of each p; the input is sorted by p."""
    p, held = None, []
    for batch in batches:
        for at in range(batch.num_rows):
            now = batch.column(0)[at].as_py()
            if now != p and held:
                yield p, held
                held = []
            p = now
            held += frames_of(batch.column(1)[at].as_py())
    if held:
        yield p, held


# --- which minimizers are shared ----------------------------------------------------------------


def _distinct(low: np.ndarray, doc_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, whether documents of different ids have them, and how often each occurs."""
    order = np.argsort(low, kind="stable")
    s, d = low[order], doc_ids[order]
    if not len(s):
        return s, np.zeros(0, bool), np.zeros(0, np.int64)
    head = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[head], np.minimum.reduceat(d, head) != np.maximum.reduceat(d, head), np.diff([*head, len(s)])


def _packed_values(places: np.ndarray, several: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising 32-bit values as differences, byte by byte; a byte for the power of two that holds the count; a bit for several documents."""
    gaps = np.diff(places, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T
    powers = np.ceil(np.log2(np.maximum(counts, 1))).astype(np.uint8)
    return len(places).to_bytes(4, "little") + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(gaps).tobytes() + powers.tobytes() + np.packbits(several).tobytes())


def _unpacked_values(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, raw = int.from_bytes(data[:4], "little"), zstandard.ZstdDecompressor().decompress(data[4:])
    gaps = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n).reshape(4, n).T).view("<u4")[:, 0]
    powers, several = np.frombuffer(raw, np.uint8, n, 4 * n), np.unpackbits(np.frombuffer(raw, np.uint8, -1, 5 * n), count=n).astype(bool)
    return np.cumsum(gaps, dtype=np.uint64).astype(np.uint32), several, 1 << powers.astype(np.int64)


def _cuts(values: np.ndarray, ranges: int) -> list[int]:
    return [0, *np.searchsorted(values, _bounds(ranges)).tolist(), len(values)]


def _sketch(ranges: int, fan: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = _to_range(ranges, grains(ranges, fan)[0])
        for batch in batches:
            for row in _rows(batch):
                b = Block(row)
                low, _, _, doc = b.runs()
                values, several, counts = _distinct(low, b.ids[doc])
                cuts = _cuts(values, ranges)
                # the place within a range to 32 bits is enough: what it confuses is only compared in vain
                places = (values * np.uint64(ranges) >> np.uint64(32)).astype(np.uint32)
                yield _rows_by(key, [(p, b.number, _packed_values(places[a:z], several[a:z], counts[a:z])) for p, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)) if z > a])

    return run


def _shared(n_blocks: int, fan: int, hot_runs: int):
    """Answers to blocks: of the values that they sent to a range those that another document has too, and those that are hot, as bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = _to_block(n_blocks, grains(n_blocks, fan)[0])
        for _, frames in _by_bucket(batches):
            sent = [_unpacked_values(x) for _, _, x in frames]
            found, at, counts = np.unique(np.concatenate([v for v, _, _ in sent]), return_inverse=True, return_counts=True)
            shared = counts > 1
            shared[at[np.concatenate([s for _, s, _ in sent])]] = True
            hot = np.bincount(at, weights=np.concatenate([c for _, _, c in sent])) > hot_runs
            bits = [(shared[i], hot[i]) for i in (np.searchsorted(found, v) for v, _, _ in sent)]
            yield _rows_by(key, [(p, b, np.packbits(np.concatenate(x)).tobytes()) for (p, b, _), x in zip(frames, bits, strict=True) if x[0].any()])

    return run


# --- strings of shared runs ---------------------------------------------------------------------


class Sent:
    """The shared strings of a block by range, as it sends them, and where they occur; made alike whenever it is asked for."""

    def __init__(self, block: Block, answers: Iterable[bytes], ranges: int):
        low, first, last, doc = block.runs()
        values, _, _ = _distinct(low, block.ids[doc])
        cuts, shared, hot = _cuts(values, ranges), np.zeros(len(values), bool), np.zeros(len(values), bool)
        for data in answers:
            for p, _, bits in frames_of(data):
                n = cuts[p + 1] - cuts[p]
                both = np.unpackbits(np.frombuffer(bits, np.uint8), count=2 * n)
                shared[cuts[p] : cuts[p + 1]], hot[cuts[p] : cuts[p + 1]] = both[:n], both[n:]
        at = np.searchsorted(values, low)
        low, first, last, doc = self._spread(block.data, shared[at] & hot[at], low, first, last, doc, np.flatnonzero(shared[at] & ~hot[at]))
        order = np.argsort(low, kind="stable")
        low, self.first, self.doc, self.size = low[order], first[order], doc[order], last[order] + WINDOW - first[order]
        # equal strings have equal keys, so they are of one range
        known: dict[bytes, int] = {}
        data, of = block.data, []
        for s, n in zip(self.first.tolist(), self.size.tolist(), strict=True):
            of.append(known.setdefault(data[s : s + n], len(known)))
        self.strings, self.of = list(known), np.array(of, np.int64)
        heads = np.flatnonzero(np.concatenate([[True], np.diff(np.maximum.accumulate(self.of)) > 0])) if of else np.zeros(0, np.int64)
        self.minimizers = low[heads]
        self.least = np.full(len(known), LAST)
        np.minimum.at(self.least, self.of, block.ids[self.doc])
        #: first string of each range and the end
        self.cuts = _cuts(self.minimizers, ranges)

    @staticmethod
    def _spread(data: bytes, hot: np.ndarray, low: np.ndarray, first: np.ndarray, last: np.ndarray, doc: np.ndarray, keep: np.ndarray):
        """The runs to keep as they are, and the hot ones window by window with hashes of the windows as keys."""
        n = (last - first + 1)[hot]
        at = np.repeat(first[hot] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        keys = np.array([xxhash.xxh3_64_intdigest(data[w : w + WINDOW]) for w in at.tolist()], np.uint64)
        return tuple(np.concatenate(x) for x in ((low[keep], keys), (first[keep], at), (last[keep], at), (doc[keep], np.repeat(doc[hot], n))))


def _packed_strings(strings: list[bytes], minimizers: np.ndarray, least: np.ndarray) -> bytes:
    lens = np.array([len(s) for s in strings], "<u4")
    raw = b"".join([len(strings).to_bytes(8, "little"), lens.tobytes(), minimizers.astype("<u8").tobytes(), least.astype("<i8").tobytes(), *strings])
    return len(raw).to_bytes(8, "little") + zstandard.ZstdCompressor(level=3).compress(raw)


def _unpacked_strings(data: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data[8:], max_output_size=max(1, int.from_bytes(data[:8], "little")))
    n = int.from_bytes(raw[:8], "little")
    lens, minimizers, least = np.frombuffer(raw, "<u4", n, 8), np.frombuffer(raw, "<u8", n, 8 + 4 * n), np.frombuffer(raw, "<i8", n, 8 + 12 * n)
    ends = (8 + 20 * n + np.cumsum(lens, dtype=np.int64)).tolist()
    return [raw[z - k : z] for z, k in zip(ends, lens.tolist(), strict=True)], minimizers, least


def _strings_of(ranges: int, fan: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = _to_range(ranges, grains(ranges, fan)[0])
        for batch in batches:
            for row in _rows(batch):
                b = Block(row)
                sent = Sent(b, row["bits"], ranges)
                spans = [(p, a, z) for p, (a, z) in enumerate(zip(sent.cuts, sent.cuts[1:], strict=False)) if z > a]
                yield _rows_by(key, [(p, b.number, _packed_strings(sent.strings[a:z], sent.minimizers[a:z], sent.least[a:z])) for p, a, z in spans])

    return run


# --- Burrows-Wheeler transforms and their merge ---------------------------------------------------


def shard_bwt(text: np.ndarray, lens: np.ndarray, depth: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(transform, suffix array, repeats) of strings laid end to end (uint8 text, their lengths).

    No string is empty. Suffixes end with their string; an end sorts before all bytes, and ends, like equal suffixes, in the order
    of their strings. The ends of the strings are the first rows. The transform has 0 where a string begins, else the byte before
    a suffix plus 1. repeats: whether a row shares depth bytes at least with the row before.
    """
    n = len(text)
    ends = np.cumsum(lens)
    left = np.repeat(ends, lens) - np.arange(n)  # bytes from here to the end of the string
    # the first few bytes, each as 9 bits, and then doubling of ranks
    at = min(7, depth)
    key = np.zeros(n, np.uint64)
    for k in range(at):
        sym = np.zeros(n, np.uint64)
        if n > k:
            sym[: n - k] = np.where(left[: n - k] > k, text[k:].astype(np.uint64) + np.uint64(1), np.uint64(0))
        key = (key << np.uint64(9)) | sym
    sa = np.argsort(key, kind="stable")
    rank = _ranks(key[sa], sa, n)
    known, by = at, rank  # the ranks by most bytes, but not more than depth
    while at < int(lens.max(initial=0)) and int(rank.max(initial=0)) < n - 1:
        after = np.full(n, -1, np.int64)
        if n > at:
            after[: n - at] = np.where(left[: n - at] > at, rank[at:], -1)
        both = rank * (n + 1) + after + 1
        sa = np.argsort(both, kind="stable")
        rank = _ranks(both[sa], sa, n)
        at *= 2
        if at <= depth:
            known, by = at, rank
    repeats = np.zeros(n, bool)
    if n > 1:
        a, b, on = sa[:-1], sa[1:], depth - known
        long = np.flatnonzero((left[a] >= depth) & (left[b] >= depth))
        a, b = a[long], b[long]
        repeats[long + 1] = (by[a] == by[b]) & (by[a + on] == by[b + on])
    symbol = np.zeros(n, np.int16)
    symbol[1:] = text[:-1].astype(np.int16) + 1
    symbol[ends - lens] = 0
    symbol = np.concatenate([text[ends - 1].astype(np.int16) + 1, symbol[sa]])
    return symbol, np.concatenate([ends, sa]), np.concatenate([np.zeros(len(lens), bool), repeats])


def _ranks(sorted_keys: np.ndarray, sa: np.ndarray, n: int) -> np.ndarray:
    new = np.zeros(n, np.int64)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    rank = np.empty(n, np.int64)
    rank[sa] = np.cumsum(new)
    return rank


def merge_repeats(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Intervals of several shards with a common prefix of depth in the merge of the shards' transforms.

    Returns rows of the shards laid end to end, in the merged order, and where each interval begins among them.
    A round takes each row to the row of the suffix that is one symbol longer: of equal symbols of a shard's transform the
    first leads to the first such row, and so on, as its rows are sorted. The rows, counted in by symbol and else in the
    order they had, are then merged up to one symbol more. Neighbours part in the round in which their symbols first differ;
    until then they are one block. Blocks of one shard alone need no further round and leave.
    """
    base = np.cumsum([0, *map(len, transforms)])
    symbols = np.concatenate(transforms)
    symbols = symbols.astype(np.uint8 if symbols.max(initial=0) < 256 else np.uint16)  # UTF-8 has no byte 255
    longer = np.empty(base[-1], np.int32)
    for a, z in zip(base, base[1:], strict=False):
        longer[a + np.argsort(symbols[a:z], kind="stable")] = np.arange(a, z, dtype=np.int32)
    shard = np.repeat(np.arange(len(transforms), dtype=np.int32), np.diff(base))
    rows, block = np.arange(base[-1], dtype=np.int32), np.zeros(base[-1], np.int32)
    for _ in range(depth if len(transforms) > 1 else 0):
        c = symbols[rows]
        inside = c > 0  # what begins a string has nothing before it
        if not inside.all():
            rows, block, c = rows[inside], block[inside], c[inside]
        order = np.argsort(c, kind="stable")
        c, block, rows = c[order], block[order], longer[rows[order]]
        head = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (block[1:] != block[:-1])])) if len(rows) else np.zeros(0, np.int64)
        sizes = np.diff([*head, len(rows)])
        # shards keep their order within a block, so the first and the last row tell whether there are several
        mixed = shard[rows[head]] != shard[rows[head + sizes - 1]]
        stay = np.repeat(mixed, sizes)
        rows, block = rows[stay], np.repeat(np.arange(int(mixed.sum()), dtype=np.int32), sizes[mixed])
        if not len(rows):
            break
    else:
        if len(transforms) > 1:
            return rows, np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    return np.zeros(0, np.int32), np.zeros(0, np.int64)


def least_ids(contents: list[bytes], ids: np.ndarray, shard_bytes: int = SHARD_BYTES, depth: int = WINDOW) -> np.ndarray:
    """Per byte of the strings laid end to end the least id of a string that holds the window starting there.

    Windows reach no further than their string; for other places the value is the string's own id.
    """
    lens = np.array([len(c) for c in contents], np.int64)
    starts = np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64)
    text, least = np.frombuffer(b"".join(contents), np.uint8), np.repeat(ids, lens)
    shard_of = starts // shard_bytes
    heads = np.flatnonzero(np.concatenate([[True], shard_of[1:] != shard_of[:-1]]))
    transforms, places = [], []
    for a, z in zip(heads, [*heads[1:], len(lens)], strict=True):
        lo, hi = int(starts[a]), int(starts[z - 1] + lens[z - 1])
        transform, sa, repeats = shard_bwt(text[lo:hi], lens[a:z], depth)
        transforms.append(transform)
        places.append(sa + lo)
        _take_least(least, places[-1][z - a :], np.flatnonzero(~repeats[z - a :]))
    rows, begins = merge_repeats(transforms, depth)
    if len(rows):
        _take_least(least, np.concatenate(places)[rows], begins)
    return least


def _take_least(least: np.ndarray, places: np.ndarray, begins: np.ndarray) -> None:
    """All places of an interval get its least value."""
    if len(places):
        least[places] = np.repeat(np.minimum.reduceat(least[places], begins), np.diff([*begins, len(places)]))


_FOUND = np.dtype([("string", "<i4"), ("start", "<i4"), ("end", "<i4"), ("least", "<i8")])


def _least_of(n_blocks: int, fan: int, shard_bytes: int):
    """Answers to blocks: the windows of the strings they sent that a smaller doc_id has elsewhere, as runs of one least doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = _to_block(n_blocks, grains(n_blocks, fan)[0])
        for _, frames in _by_bucket(batches):
            index: dict[bytes, int] = {}
            own, sent = [], []
            for _, _, data in frames:
                held, minimizers, least = _unpacked_strings(data)
                own.append(np.array([index.setdefault(s, len(index)) for s in held], np.int64))
                sent.append((minimizers, least))
            contents = list(index)
            lens = np.array([len(c) for c in contents], np.int64)
            starts = np.cumsum(lens) - lens
            every = np.concatenate(own)
            least_string, of = np.full(len(contents), LAST), np.zeros(len(contents), np.uint64)
            np.minimum.at(least_string, every, np.concatenate([x for _, x in sent]))
            of[every] = np.concatenate([m for m, _ in sent])
            least = np.repeat(least_string, lens)
            _, which, times = np.unique(of, return_inverse=True, return_counts=True)
            several = np.flatnonzero(times[which] > 1)
            # different minimizers have nothing to tell each other: as many merges as keep each one small
            merges = -(-int(lens[several].sum()) // (4 * shard_bytes))
            for k in range(merges):
                now = several[which[several] % merges == k]
                if len(now):
                    there = np.repeat(starts[now] - (np.cumsum(lens[now]) - lens[now]), lens[now]) + np.arange(int(lens[now].sum()))
                    least[there] = least_ids([contents[c] for c in now.tolist()], least_string[now], shard_bytes)
            # runs of windows of one string with one least doc_id
            windows = np.arange(len(least)) - np.repeat(starts, lens) <= np.repeat(lens, lens) - WINDOW
            new = np.ones(len(least), bool)
            new[1:] = (least[1:] != least[:-1]) | (windows[1:] != windows[:-1])
            new[starts] = True
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(least))
            begin, end = begin[windows[begin]], end[windows[begin]]
            string = np.searchsorted(starts, begin, "right") - 1
            runs_from = np.searchsorted(string, np.arange(len(contents) + 1))
            out = []
            for (p, b, _), mine, (_, known) in zip(frames, own, sent, strict=True):
                n = runs_from[mine + 1] - runs_from[mine]
                run_of = np.repeat(runs_from[mine] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                sender = np.repeat(np.arange(len(mine)), n)
                news = least[begin[run_of]] < known[sender]
                run_of, sender = run_of[news], sender[news]
                if len(run_of):
                    rows = np.empty(len(run_of), _FOUND)
                    at = starts[string[run_of]]
                    rows["string"], rows["start"], rows["end"], rows["least"] = sender, begin[run_of] - at, end[run_of] - at, least[begin[run_of]]
                    out.append((p, b, zstandard.ZstdCompressor(level=1).compress(rows.tobytes())))
            if out:
                yield _rows_by(key, out)

    return run


# --- results ---------------------------------------------------------------------------------------


def removed_bytes(b: Block, sent: Sent, answers: Iterable[bytes]) -> np.ndarray:
    """Which bytes of a block go, as told by the ranges and by its own least doc_ids."""
    lens = np.array([len(s) for s in sent.strings], np.int64)
    starts = np.cumsum(lens) - lens
    least = np.repeat(sent.least, lens)  # of the window at each place of the block's distinct strings
    for data in answers:
        for p, _, found in frames_of(data):
            r = np.frombuffer(zstandard.ZstdDecompressor().decompress(found), _FOUND)
            at = starts[sent.cuts[p] + r["string"]]
            n = (r["end"] - r["start"]).astype(np.int64)
            places = np.repeat(at + r["start"] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            least[places] = np.repeat(r["least"], n)
    # occurrences in pieces of bounded size, window by window
    gone = np.zeros(len(b.data) + 1, np.int32)
    windows = sent.size - WINDOW + 1
    total = np.cumsum(windows)
    at = 0
    while at < len(windows):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + (4 << 20), "right")))
        n = windows[at:to]
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        hit = least[np.repeat(starts[sent.of[at:to]], n) + inner] < np.repeat(b.ids[sent.doc[at:to]], n)
        where = (np.repeat(sent.first[at:to], n) + inner)[hit]
        gone += np.bincount(where, minlength=len(gone)).astype(np.int32) - np.bincount(where + WINDOW, minlength=len(gone)).astype(np.int32)
        at = to
    return np.cumsum(gone[:-1]) > 0


def _results(ranges: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                b = Block(row)
                gone = removed_bytes(b, Sent(b, row["bits"] or [], ranges), row["found"] or [])
                x = np.frombuffer(b.data, np.uint8)
                rows = []
                for i, null, s, n in zip(b.ids.tolist(), b.nulls.tolist(), b.starts.tolist(), b.sizes.tolist(), strict=True):
                    g = gone[s : s + n]
                    removed = int(g.sum())
                    kept = x[s : s + n][~g].tobytes() if removed else b.data[s : s + n]
                    spans = int((g[1:] & ~g[:-1]).sum() + g[0]) if removed else 0
                    rows.append((None if null else i, n, removed, spans, hashlib.sha256(kept).hexdigest(), *([kept] if with_text else [])))
                kinds = (*[pa.int64()] * 4, pa.string(), *([pa.binary()] if with_text else []))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else [])])

    return run


def _kept_dealt(df: DataFrame, key: str) -> DataFrame:
    """Deals rows by key once and keeps them so, cut from their lineage: later joins on the key leave them where they are.

    Only a plan that is fixed beforehand tells later ones how its rows are dealt, so this one is planned without adaptive
    execution. The setting is back before any job of it runs.
    """
    conf = df.sparkSession.conf
    out = df.repartition(int(conf.get("spark.sql.shuffle.partitions")), key)
    adaptive = conf.get("spark.sql.adaptive.enabled")
    try:
        conf.set("spark.sql.adaptive.enabled", "false")
        out._jdf.queryExecution().executedPlan()
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)
    return cut(out)


def dedup(docs: DataFrame, with_text: bool = False, block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES, shard_bytes: int = SHARD_BYTES, fan: int = FAN, hot_runs: int = HOT_RUNS) -> DataFrame:
    """Per row of documents: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if with_text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    block_rows = _kept_dealt(texts.mapInArrow(_to_blocks(block_bytes), _BLOCK_SCHEMA), "block")
    size = block_rows.agg(F.sum("n_bytes").alias("n"), F.count("*").alias("blocks")).first()
    # as many ranges as one dealing reaches, or more, so that rows grow with blocks alone
    ranges, n_blocks = max(fan, -(-int(size["n"] or 0) // range_bytes)), max(1, size["blocks"])

    def by_block(answers: DataFrame, name: str) -> DataFrame:
        return dealt(answers, _to_block, n_blocks, fan).groupBy(F.col("p").alias("block")).agg(F.collect_list("data").alias(name))

    sketches = block_rows.mapInArrow(_sketch(ranges, fan), _DEALT)
    asked = cut(by_block(dealt(sketches, _to_range, ranges, fan).mapInArrow(_shared(n_blocks, fan, hot_runs), _DEALT), "bits"))
    found = block_rows.join(asked, "block").mapInArrow(_strings_of(ranges, fan), _DEALT)
    least = dealt(found, _to_range, ranges, fan).mapInArrow(_least_of(n_blocks, fan, shard_bytes), _DEALT)
    kept = ", kept binary" if with_text else ""
    told = block_rows.join(asked, "block", "left").join(by_block(least, "found"), "block", "left")
    return told.mapInArrow(_results(ranges, with_text), f"doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string{kept}")
