"""MinHash near-dedup by an LSH forest.

A document's set holds its distinct 5-word shingles as 64-bit hashes. Documents with equal sets are one class.
Each class has K minima of its set under K hash functions. The forest has TREES orders of that signature, each starting at
another place of it. In each order the classes stand sorted; those that agree on the first DEPTH values or more are a region.

1. Each order is sorted over all machines, a region however large being spread over as many tasks as it fills. Neighbours
   there, also those on either side of a border between tasks, are candidates. Of all orders the pairs with the longest common
   prefix that connect the classes are confirmed; where some fail, the next longest ones that connect what is left follow, for a
   few rounds. They connect most groups of copies with little more than one pair a class.
2. Within every region classes that are in different components yet are compared, all with all. A region of more than
   REGION rows of a task is first cut where the common prefixes of neighbours are shortest, deeper and deeper until the parts
   are small; this is where depth adapts.
3. What was cut is compared too: where a region has several parts and still holds several components, the members
   outside the largest component are compared with all of the region, block by block in the sorted order. So nothing
   that meets in an order goes uncompared, however large its region.

Comparisons in a region count by SHORT-bit hashes of the sets, with all the slack that collisions within the sets can ask
for, so no link is missed. A pair that links two components is a candidate and joins them at once, so a group of copies
gives about one candidate a class. Candidates are confirmed on full sets, 100 * intersection >= 75 * union. Should one
fail, its region is compared anew on full sets, so nothing hides behind it. Components are formed over confirmed links only.
Two sets with a similarity of 0.75 miss each other in all 32 orders with a probability of 5e-6.
Sets are read again from the texts, only for classes that met another one.

Defined cases: null or empty texts and texts without words have an empty set and are linked with nothing; with fewer than
five words the whole sequence is the one shingle; very long texts are read whole, and their sets are compared whole; a null
doc_id is a row of its own, linked with nothing; rows with equal doc_id count as one node, repeated rows among them; ties in
an order are sorted by id; an empty table gives no row; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelforge.llm.common import blocks, components, cut, small_or_dealt, stored, strings

WIDTH = 5
K, TREES, DEPTH = 128, 32, 4
STRIDE = K // TREES
#: Values of an order by which rows are sorted and common prefixes are measured.
SORTED = 16
REGION = 1024
SHORT = 32
FOREST_EDGES = 500_000
ROWS_A_TASK = 500_000
#: Rounds in which neighbours are tried, a forest of them at a time.
NEIGHBOUR_ROUNDS = 4

_MIX = np.uint64(0x9E3779B97F4A7C15)
_A = np.random.default_rng(20240229).integers(1, 1 << 32, K, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_B = np.random.default_rng(20240301).integers(0, 1 << 32, K, dtype=np.uint64).astype(np.uint32)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= 400_000:
                self.clear()
            self[word] = h
        return h


def shingle_set(text: bytes, hashes: dict[bytes, int], width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a UTF-8 text; bytes.lower and bytes.split know ASCII only."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    span = min(n, width)
    s = np.full(n - span + 1, span, np.uint64)
    for k in range(span):
        s = (s ^ h[k : n - span + 1 + k]) * _MIX
        s ^= s >> np.uint64(29)
    return np.unique(_mixed(s))


def signature(shingles: np.ndarray) -> np.ndarray:
    """K minima as uint32; the hash functions mix both halves of each 64-bit hash."""
    low, high = (shingles & np.uint64(0xFFFFFFFF)).astype(np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(K, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 4096):
        x = low[at : at + 4096, None] * _A[None, :]
        x ^= (high[at : at + 4096, None] ^ _B[None, :])
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0xC2B2AE35)
        np.minimum(out, x.min(axis=0), out=out)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for b in blocks(batches):
        n, digests, sigs = [], [], []
        for doc_id, text in zip(b.column(0).to_pylist(), strings(b.column(1)), strict=True):
            s = shingle_set(text, hashes)
            n.append(len(s))
            known = len(s) and doc_id is not None
            digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if known else None)
            sigs.append(signature(s).tobytes() if known else None)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())], ["doc_id", "n_shingles", "digest", "sig"])


def _order(sig: np.ndarray, tree: int) -> np.ndarray:
    """Signatures (rows of K uint32) as an order reads them, from its own place on."""
    at = tree * STRIDE
    return np.concatenate([sig[:, at:], sig[:, :at]], axis=1)


def _key(values: np.ndarray, tree: int) -> np.ndarray:
    """One 64-bit key per row for its values in an order of that number."""
    h = np.full(len(values), tree + 1, np.uint64)
    for c in values.T:
        h = _mixed((h ^ c.astype(np.uint64)) * _MIX)
    return h.view(np.int64)


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, K)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            sig, ids = _signatures(b.column(1)), b.column(0).to_numpy()
            keys = np.concatenate([_key(_order(sig, t)[:, :DEPTH], t) for t in range(TREES)])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.tile(ids, TREES))], ["key", "id"])


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of rows sorted by key whose key another row has; the first and last row of a task may meet one of another task."""
    last_key, last_id, last_told, first = None, None, True, True
    for b in batches:
        if not b.num_rows:
            continue
        key, ids = b.column(0).to_numpy(), b.column(1).to_numpy()
        same = key[1:] == key[:-1]
        met = np.zeros(len(key), bool)
        met[1:] |= same
        met[:-1] |= same
        met[0] |= first or key[0] == last_key
        out = ids[met]
        if not first and not last_told and key[0] == last_key:
            out = np.append(out, last_id)
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(out), pa.int64())], ["id"])
        last_key, last_id, last_told, first = key[-1], ids[-1], bool(met[-1]), False
    if not last_told:
        yield pa.RecordBatch.from_arrays([pa.array([last_id], pa.int64())], ["id"])


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of all orders: the number of the order and its first SORTED values as sortable bytes, and the id."""
    width = 1 + 4 * SORTED
    for b in batches:
        if not b.num_rows:
            continue
        sig = _signatures(b.column(1))
        for t in range(TREES):
            rows = np.empty((len(sig), width), np.uint8)
            rows[:, 0] = t
            rows[:, 1:] = np.ascontiguousarray(_order(sig, t)[:, :SORTED].astype(">u4")).view(np.uint8)
            place = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(sig), [None, pa.py_buffer(rows.tobytes())])
            yield pa.RecordBatch.from_arrays([place.cast(pa.binary()), b.column(0)], ["place", "id"])


def common_prefixes(values: np.ndarray) -> np.ndarray:
    """Values that each row of a sorted matrix shares with the row before it; 0 for the first one."""
    out = np.zeros(len(values), np.int64)
    if len(values) > 1:
        differs = values[1:] != values[:-1]
        out[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), values.shape[1])
    return out


def adaptive_parts(prefixes: np.ndarray, most: int) -> np.ndarray:
    """Where the parts of a region begin: cut where common prefixes are shortest, until no part has more than `most` rows.

    prefixes: common prefixes of the region's rows with the row before. Rows that are alike in all values are cut by number.
    """
    begins, todo = [], [(0, len(prefixes), DEPTH)]
    while todo:
        lo, hi, depth = todo.pop()
        if hi - lo <= most:
            begins.append(lo)
            continue
        inner = prefixes[lo + 1 : hi]
        depth = max(depth, int(inner.min()) + 1)
        if depth > SORTED:
            begins += range(lo, hi, most)
            continue
        cuts = [lo, *(lo + 1 + np.flatnonzero(inner < depth)).tolist(), hi]
        # neighbouring parts that are small together stay together: depth adapts to where rows are dense
        at = 0
        while at < len(cuts) - 1:
            to = at + 1
            while to < len(cuts) - 1 and cuts[to + 1] - cuts[at] <= most:
                to += 1
            todo.append((cuts[at], cuts[to], depth + 1))
            at = to
    return np.sort(np.array(begins, np.int64))


_FOREST = "key long, part long, block long, id long, before long, prefix int, place binary"
_FOREST_NAMES = [c.split()[0] for c in _FOREST.split(", ")]
_HEAD, _WIDTH = 1 + 4 * DEPTH, 1 + 4 * SORTED


def _forest_rows(region: int):
    """Rows sorted by place to the rows of regions, each with its part, its block (`region` rows by number) and the neighbour before it.

    Besides, the first and the last row of a task are told with their places (key null, part the task, block 0 and 1), so
    that they meet their neighbours of other tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n_parts, n_blocks = (TaskContext.get().partitionId() + 1) << 32, 0, 0

        def told(rows: np.ndarray, ids: np.ndarray, first: bool, last: bool) -> pa.RecordBatch:
            """Whole regions; those of one row stay only at the beginning and the end of a task."""
            nonlocal n_parts, n_blocks
            n = len(ids)
            begins = np.flatnonzero(np.concatenate([[True], (rows[1:, :_HEAD] != rows[:-1, :_HEAD]).any(axis=1)]))
            sizes = np.diff([*begins, n])
            keep = sizes > 1
            keep[0] |= first
            keep[-1] |= last
            rows, ids, sizes = rows[np.repeat(keep, sizes)], ids[np.repeat(keep, sizes)], sizes[keep]
            n, begins = len(ids), np.cumsum(sizes) - sizes
            values = np.ascontiguousarray(rows[:, 1:]).view(">u4").astype(np.uint32)
            prefixes = common_prefixes(values)
            prefixes[begins] = 0
            part_begins, block_begins = [begins], [begins]
            for k in np.flatnonzero(sizes > region).tolist():
                part_begins.append(begins[k] + adaptive_parts(prefixes[begins[k] : begins[k] + sizes[k]], region))
                block_begins.append(np.arange(begins[k], begins[k] + sizes[k], region))
            parts, of_blocks = (np.searchsorted(np.unique(np.concatenate(x)), np.arange(n), "right") - 1 for x in (part_begins, block_begins))
            keys = np.zeros(len(begins), np.int64)
            for t in np.unique(rows[begins, 0]):
                here = rows[begins, 0] == t
                keys[here] = _key(values[begins[here], :DEPTH], int(t))
            alone = np.zeros(n, bool)
            alone[begins] = True
            before = pa.array(np.concatenate([[0], ids[:-1]]) if n else ids, pa.int64(), mask=alone)
            cols = [np.repeat(keys, sizes), base + n_parts + parts, base + n_blocks + of_blocks, ids]
            n_parts, n_blocks = n_parts + int(parts[-1] + 1 if n else 0), n_blocks + int(of_blocks[-1] + 1 if n else 0)
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), before, pa.array(prefixes, pa.int32()), pa.nulls(n, pa.binary())], _FOREST_NAMES)

        def edge(rows: np.ndarray, ids: np.ndarray, last: int) -> pa.RecordBatch:
            cols = [None, base, last, int(ids[-last]), None, None, rows[-last].tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cols, (*[pa.int64()] * 5, pa.int32(), pa.binary()), strict=True)], _FOREST_NAMES)

        held: list[tuple[np.ndarray, np.ndarray]] = []  # rows of the region that is read
        first = True
        for b in batches:
            if not b.num_rows:
                continue
            rows, ids = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint8).reshape(-1, _WIDTH), b.column(1).to_numpy()
            if first and not held:
                yield edge(rows, ids, 0)
            goes_on = (rows[:, :_HEAD] == rows[-1, :_HEAD]).all(axis=1)  # the last region's rows
            at = len(rows) - int(goes_on.sum())
            if at or (held and not np.array_equal(held[-1][0][-1, :_HEAD], rows[0, :_HEAD])):
                held.append((rows[:at], ids[:at]))
                yield told(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), first, False)
                held, first = [], False
            held.append((rows[at:], ids[at:]))
        if held:
            rows, ids = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            yield told(rows, ids, first, True)
            yield edge(rows, ids, 1)

    return run


def short_set(shingles: np.ndarray) -> bytes:
    """The set by SHORT-bit hashes: its true size, then differences of the sorted distinct hashes, byte by byte, compressed."""
    v = np.unique(shingles >> np.uint64(64 - SHORT))
    gaps = np.diff(v, prepend=np.uint64(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return len(shingles).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(gaps).tobytes())


def long_set(short: bytes) -> tuple[int, np.ndarray]:
    """(true size, distinct short hashes)."""
    raw = zstandard.ZstdDecompressor().decompress(short[8:])
    gaps = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4")[:, 0]
    return int.from_bytes(short[:8], "little"), np.cumsum(gaps, dtype=np.int64)


def _full_set(shingles: bytes) -> tuple[int, np.ndarray]:
    v = np.frombuffer(shingles, np.uint64)
    return len(v), v


def linking(ids: np.ndarray, comps: np.ndarray, sets: list[tuple[int, np.ndarray]]) -> list[tuple[int, int]]:
    """Candidates between different components of a group; sets are (true size, distinct hashes).

    Members outside the largest component are compared with all; a candidate joins components at once. Hashes that collided
    within both sets may have hidden as many common elements, so that many are granted: no link is passed over. Of
    several partners in a component the one with the least id is taken, so that different groups tend to name the same pair.
    """
    n, full, sizes = len(ids), np.array([k for k, _ in sets]), np.array([len(s) for _, s in sets])
    lost = full - sizes
    values = np.concatenate([s for _, s in sets])
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    head = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    ends = np.append(head[1:], len(values))
    known = values[head]
    code = np.unique(comps, return_inverse=True)[1].copy()
    largest = np.bincount(code).argmax()
    out = []
    for i in np.flatnonzero(code != largest).tolist():
        if (code == code[i]).all():
            break
        at = np.searchsorted(known, sets[i][1])
        many = ends[at] - head[at] > 1
        a, size = head[at[many]], (ends[at] - head[at])[many]
        flat = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        both = np.minimum(np.bincount(owner[flat], minlength=n) + np.minimum(lost, lost[i]), np.minimum(full, full[i]))
        hit = np.flatnonzero((100 * both >= 75 * (full + full[i] - both)) & (code != code[i]))
        for j in hit[np.argsort(ids[hit], kind="stable")].tolist():
            if code[j] != code[i]:
                out.append((int(ids[i]), int(ids[j])))
                code[code == code[j]] = code[i]
    return out


def _within(column: str):
    """linking() over rows sorted by key, whose groups are bounded; column holds short or full sets."""
    read = long_set if column == "short" else _full_set

    def pairs(key: int, rows: list[tuple]) -> pa.RecordBatch:
        found = linking(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), [read(r[2]) for r in rows])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in ([key] * len(found), [a for a, _ in found], [b for _, b in found])], ["key", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for k, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "component", column)), strict=True):
                if k != key:
                    if len(held) > 1:
                        yield pairs(key, held)
                    held = []
                key = k
                held.append(row)
        if len(held) > 1:
            yield pairs(key, held)

    return run


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to rows (key, id, component) sorted by key the task and the row's number among those of its key in the task."""
    task, key, number = TaskContext.get().partitionId(), None, 0
    for b in batches:
        numbers = []
        for k in b.column(0).to_pylist():
            number = number + 1 if k == key else 0
            key = k
            numbers.append(number)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([task] * len(numbers), pa.int32()), pa.array(numbers, pa.int64())], [*b.schema.names, "task", "number"])


def chunked(rows: DataFrame, most: int) -> DataFrame:
    """Adds chunk to rows (key, id, component): each key's rows in their sorted order, `most` to a chunk whatever tasks they lie in."""
    numbered = cut(by_range(rows, rows.count(), "key", "id").mapInArrow(_numbers, "key long, id long, component long, task int, number long"))
    counts = numbered.groupBy("key", "task").agg(F.count("*").alias("n"))  # one row a key and task
    before = (F.sum("n").over(Window.partitionBy("key").orderBy("task")) - F.col("n")).alias("before")
    placed = numbered.join(counts.select("key", "task", before), ["key", "task"])
    return placed.select("key", "id", "component", F.floor((F.col("before") + F.col("number")) / most).alias("chunk"))


def rest_groups(rows: DataFrame, region: int) -> DataFrame:
    """Groups (key, id, component) that let all of rows (key, block, id, component) of a key be compared with those outside its largest component.

    The latter are cut into chunks in their sorted order; a group is one chunk with one block, at most twice `region` rows.
    """
    per = rows.groupBy("key", "component").agg(F.count("*").alias("c"))
    most = per.groupBy("key").agg(F.max_by("component", F.struct("c", "component")).alias("giant"), F.count("*").alias("n")).where("n > 1").select("key", "giant")
    x = cut(rows.join(most, "key"))
    out = cut(chunked(x.where("component <> giant").select("key", "id", "component"), region))
    groups = out.select("key", "chunk").distinct().join(x.select("key", "block").distinct(), "key").withColumn("group", F.xxhash64("key", "chunk", "block"))
    members = x.join(groups, ["key", "block"]).select(F.col("group").alias("key"), "id", "component")
    asking = out.join(groups, ["key", "chunk"]).select(F.col("group").alias("key"), "id", "component")
    return members.union(asking).distinct()


def by_range(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """Rows sorted by keys over all tasks, a hot key being spread over as many as it fills: at most about ROWS_A_TASK rows each."""
    tasks, usual = -(-n // ROWS_A_TASK), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(tasks, *keys) if tasks > usual else rows.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for b in blocks(batches):
        found = [shingle_set(t, hashes) for t in strings(b.column(1))]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in found], pa.binary()), pa.array([short_set(s) for s in found], pa.binary())], ["id", "shingles", "short"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in blocks([batch]):
            keep = []
            for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist(), strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if 100 * min(len(p), len(q)) < 75 * max(len(p), len(q)):
                    keep.append(False)
                    continue
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= 75 * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(keep)), b.column("b").filter(pa.array(keep))], ["a", "b"])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs (a, b, component of a, of b) those that join two trees of components, in the order in which they come."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, top)
        return top

    for batch in batches:
        keep = []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = find(a), find(b)
            if x != y:
                parent[x] = y
            keep.append(x != y)
        yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(keep, pa.bool_())) for k in (0, 1)], ["a", "b"])


def ordered_pairs(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (a, b, prefix), the larger id first, with the longest prefix that they share anywhere."""
    return cut(pairs.where("a <> b").groupBy(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).agg(F.max("prefix").alias("prefix")))


def forest_of(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) of pairs (a, b, prefix, ca, cb) that connect what all of them connect, longer common prefixes first.

    ca and cb are the components that are known already; about one pair for each of them is kept. A task sees FOREST_EDGES pairs,
    so what two tasks connect twice is kept twice.
    """
    tasks = max(1, -(-pairs.count() // FOREST_EDGES))
    dealt = pairs.repartition(tasks, "cb").sortWithinPartitions(F.desc("prefix"), "b", "a").select("a", "b", "ca", "cb")
    return cut(dealt.mapInArrow(_forest, "a long, b long"))


def neighbour_links(pairs: DataFrame, exact: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, components) of neighbours (a, b, prefix) and exact links: each round confirms a forest of pairs that are untried."""
    left, links = ordered_pairs(pairs).withColumns({"ca": F.col("a"), "cb": F.col("b")}), exact
    for n in range(NEIGHBOUR_ROUNDS):
        kept = forest_of(left)
        links = links.union(confirmed(kept, sets))
        comps = components(links)
        if n + 1 == NEIGHBOUR_ROUNDS:
            break
        untried = left.select("a", "b", "prefix").join(kept, ["a", "b"], "left_anti")
        for side in ("a", "b"):
            untried = untried.join(comps.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")), side, "left").withColumn(f"c{side}", F.coalesce(f"c{side}", side))
        left = cut(untried.where("ca <> cb"))
        if not left.limit(1).count():
            break
    return links, comps


def links_within(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that connect all that is linked within a key of rows (key, id, component), given the components.

    Different keys name different pairs of the same components; of all named pairs a forest is confirmed. Should one of its
    pairs fail, all named pairs are confirmed instead, and keys that named a failing one are compared anew on
    full sets, which cannot fail.
    """

    def named(rows: DataFrame, column: str) -> DataFrame:
        full = rows.join(sets.select("id", column), "id")
        return cut(full.repartition("key").sortWithinPartitions("key", "id").mapInArrow(_within(column), "key long, a long, b long"))

    rows = cut(rows)
    found = named(rows, "short")
    kept = forest_of(ordered_pairs(found.select("a", "b", F.lit(0).alias("prefix"))).withColumns({"ca": F.col("a"), "cb": F.col("b")}))
    links = confirmed(kept, sets)
    if links.count() == kept.count():
        return links
    every = confirmed(found, sets)
    sides = found.select("key", F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    failed = cut(sides.join(every, ["a", "b"], "left_anti").select("key").distinct())
    return every.union(named(rows.join(failed, "key", "left_semi"), "shingles").select("a", "b"))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of pairs(a, b) whose full sets are similar enough."""
    p = pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    both = p.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    return cut(both.mapInArrow(_confirm, "a long, b long").distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of documents: doc_id, n_shingles, component_id, kept."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = cut(texts.mapInArrow(_sign, "doc_id long, n_shingles long, digest binary, sig binary"))
    known = signed.where("digest is not null")
    # one class per distinct set; its least doc_id stands for it
    classes = cut(known.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig")))
    # a doc_id of several rows may stand in several classes: they are one node
    one_id = known.groupBy("digest", "doc_id").agg(F.lit(1).alias("_")).groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    twice = known.join(one_id, "doc_id", "left_semi").join(classes.select("digest", "id"), "digest").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    exact = cut(twice.where("a <> b"))

    # who meets anyone in any order
    keys = classes.select("id", "sig").mapInArrow(_keys, "key long, id long")
    met = cut(by_range(keys, TREES * classes.count(), "key", "id").mapInArrow(_meeting, "id long").distinct())
    n_met = met.count()
    sigs = cut(classes.select("id", "sig").join(small_or_dealt(met), "id", "left_semi"))
    # texts are read a second time for the classes that met another one
    from_rows = texts.join(small_or_dealt(met.select(F.col("id").alias("doc_id"))), "doc_id", "left_semi")
    sets = cut(from_rows.mapInArrow(_sets, "id long, shingles binary, short binary"))

    # the sorted orders: neighbours of all of them, over borders too
    places = sigs.mapInArrow(_places, "place binary, id long")
    forest = stored(by_range(places, TREES * n_met, "place", "id").mapInArrow(_forest_rows(REGION), _FOREST))
    inside = forest.where("before is not null").select(F.col("id").alias("a"), F.col("before").alias("b"), "prefix")
    along = Window.orderBy("part", "block")  # two rows a task
    border = forest.where("key is null").select("id", "block", F.substring("place", 1, _HEAD).alias("head"), F.lag("id").over(along).alias("before"), F.lag(F.substring("place", 1, _HEAD)).over(along).alias("last"))
    border = border.where("block = 0 and head = last").select(F.col("id").alias("a"), F.col("before").alias("b"), F.lit(DEPTH).alias("prefix"))
    links, comps = neighbour_links(inside.union(border), exact, sets)

    # all with all within the parts of regions, and then parts with each other
    regions = forest.where("key is not null").select("key", "part", "block", "id")
    at = stored(_with_components(regions, comps))
    parts = at.select(F.col("part").alias("key"), "id", "component")
    links = links.union(links_within(_several(parts), sets))
    cut_up = regions.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("key")
    comps = components(links)
    rest = _several(_with_components(regions.join(cut(cut_up), "key", "left_semi").select("key", "block", "id"), comps))
    rest = cut(rest_groups(rest, REGION))
    if rest.limit(1).count() and (more := links_within(rest, sets)).limit(1).count():
        comps = components(links.union(more))

    per = classes.select("digest", "id").join(comps.select(F.col("node").alias("id"), "component"), "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    out = signed.drop("sig").join(per, "digest", "left")
    own = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(False)).alias("kept"))


def _with_components(rows: DataFrame, comps: DataFrame) -> DataFrame:
    joined = rows.join(comps.select(F.col("node").alias("id"), "component"), "id", "left")
    return joined.withColumn("component", F.coalesce("component", "id"))


def _several(rows: DataFrame) -> DataFrame:
    """Rows of keys that hold more than one component."""
    mixed = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    return rows.join(mixed, "key", "left_semi")


def keep_first(docs: DataFrame) -> DataFrame:
    """documents without the near copies: one row of each group stays, with all columns of documents.

    Rows whose doc_id is null or repeated are told apart by their text: they get an id beyond all others (the hash of
    id and text), so equal rows are copies of each other, and a text of its own stays though its id has another text too.
    """
    d = docs.select("doc_id", "text", "lang", "source", "n_chars")
    twice = cut(d.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").select(F.coalesce("doc_id", F.lit(0)).alias("_id"), F.lit(True).alias("_twice")).distinct())
    own = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    named = d.join(small_or_dealt(twice), F.coalesce("doc_id", F.lit(0)) == F.col("_id"), "left").withColumn("_own", F.when(F.col("_twice"), own).otherwise(F.col("doc_id").cast("long")))
    found = near_duplicates(named.select(F.col("_own").alias("doc_id"), "text"))
    going = cut(found.where(~F.col("kept")).select(F.col("doc_id").alias("_own")).distinct())
    left = named.join(small_or_dealt(going), "_own", "left_anti")
    once, again = left.where("_twice is null"), left.where("_twice")
    first = again.groupBy("_own").agg(F.min(F.struct("doc_id", "text", "lang", "source", "n_chars")).alias("r")).select("r.*")
    return once.select(*first.columns).union(first)
