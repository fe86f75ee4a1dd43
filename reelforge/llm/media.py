"""Media columns: telephony audio in WAV files.

mu-law and A-law samples are expanded by lookup tables, IMA ADPCM blocks are decoded with numpy across blocks
(one step of all blocks at a time), and PCM is resampled in integers, by linear interpolation to higher rates and by the
mean over each new sample's stretch (which keeps what the new rate cannot hold from folding back) to lower ones.
The resampled PCM is stored as a WAV column of its own. All is vectorised over the rows of an Arrow batch; batches are
cut to a few MB, so memory does not grow with the table.

Defined cases: null media gives null results; a null or empty text is a payload of 64 zero bytes; a very long text is
one file of its whole size (WAV ends at 4 GB, more than a string holds); repeated rows and ids are rows of their own, and equal
inputs give equal results wherever they lie; nothing is ranked, so there are no ties; an empty table gives no row; columns
that are not named are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelforge.llm.common import blocks, strings

ULAW, ALAW, ADPCM, PCM = 7, 6, 0x11, 1
BLOCK = 64
RATE_IN, RATE_OUT = 8000, 16000


def _ulaw_table() -> np.ndarray:
    """G.711 mu-law: inverted bits, 3 bits of exponent, 4 of mantissa, bias 132."""
    u = ~np.arange(256) & 0xFF
    size = ((((u & 0x0F) << 3) + 132) << ((u >> 4) & 7)) - 132
    return np.where(u & 0x80, -size, size).astype(np.int16)


def _alaw_table() -> np.ndarray:
    """G.711 A-law: even bits inverted, 3 bits of exponent, 4 of mantissa."""
    a = np.arange(256) ^ 0x55
    e, m = (a >> 4) & 7, (a & 0x0F) << 4
    size = np.where(e == 0, m + 8, (m + 264) << np.maximum(e - 1, 0))
    return np.where(a & 0x80, size, -size).astype(np.int16)


ULAW_PCM, ALAW_PCM = _ulaw_table(), _alaw_table()
# IMA ADPCM step sizes and index moves.
IMA_STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307,
    337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358,
    5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], np.int32)
IMA_MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)


def decode_adpcm(data: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Mono IMA ADPCM blocks (bytes, a multiple of block) to int16, one row of 2 * (block - 4) + 1 samples a block."""
    b = data.reshape(-1, block)
    value = b[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(b[:, 2].astype(np.int32), len(IMA_STEPS) - 1)
    codes = np.ascontiguousarray(b[:, 4:].T)
    out = np.empty((2 * (block - 4) + 1, len(b)), np.int16)
    out[0] = value
    for i, byte in enumerate(codes):
        for k, code in enumerate((byte & 15, byte >> 4)):
            step = IMA_STEPS[index]
            code = code.astype(np.int32)
            delta = step >> 3
            delta += (step >> 2) * (code & 1)
            delta += (step >> 1) * ((code >> 1) & 1)
            delta += step * ((code >> 2) & 1)
            value = np.clip(np.where(code & 8, value - delta, value + delta), -32768, 32767)
            index = np.clip(index + IMA_MOVES[code & 7], 0, len(IMA_STEPS) - 1)
            out[1 + 2 * i + k] = value
    return out.T


def resample(pcm: np.ndarray, rate_in: int, rate_out: int) -> np.ndarray:
    """int16 samples at another rate, in integers rounded down; beyond the end the last sample is held."""
    if rate_in == rate_out or not len(pcm):
        return pcm.astype(np.int16)
    n, x = max(1, len(pcm) * rate_out // rate_in), pcm.astype(np.int64)
    at = np.arange(n + 1, dtype=np.int64) * rate_in  # places of the new samples in 1 / rate_out of an old one
    if rate_out < rate_in:
        at = np.minimum(at, len(x) * rate_out)
        left, part = at // rate_out, at % rate_out
        sums = np.concatenate([[0], np.cumsum(x)])[left] * rate_out + part * np.append(x, 0)[left]
        return (np.diff(sums) // np.diff(at)).astype(np.int16)
    left, part = at[:-1] // rate_out, at[:-1] % rate_out
    right = np.minimum(left + 1, len(x) - 1)
    return ((x[left] * (rate_out - part) + x[right] * part) // rate_out).astype(np.int16)


def wav(payload: bytes, kind: int = ULAW, rate: int = RATE_IN, block: int = BLOCK) -> bytes:
    """A mono RIFF/WAVE file around samples of that kind; odd sizes are padded as the format asks."""
    if kind == ADPCM:
        fmt = struct.pack("<HHIIHHHH", kind, 1, rate, rate * block // (2 * (block - 4) + 1), block, 4, 2, 2 * (block - 4) + 1)
    else:
        width = 2 if kind == PCM else 1
        fmt = struct.pack("<HHIIHH", kind, 1, rate, rate * width, width, 8 * width) + (b"" if kind == PCM else b"\0\0")
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(payload)) + payload + b"\0" * (len(payload) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wav(media: bytes) -> tuple[int, int, int, bytes]:
    """(kind, rate, block, bytes of samples) of a WAV file; ValueError for anything else."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, kind, rate, block = 12, 0, 0, 0
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            kind, _, rate, _, block = struct.unpack_from("<HHIIH", media, at + 8)
        elif name == b"data":
            return kind, rate, block, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no samples")


def to_pcm(kind: int, data: bytes, block: int = BLOCK) -> np.ndarray:
    """Samples of a known kind as int16."""
    raw = np.frombuffer(data, np.uint8)
    if kind == ULAW:
        return ULAW_PCM[raw]
    if kind == ALAW:
        return ALAW_PCM[raw]
    if kind == ADPCM:
        return decode_adpcm(raw[: len(raw) // block * block], block).ravel()
    if kind == PCM:
        return np.frombuffer(data[: len(data) // 2 * 2], "<i2")
    raise ValueError(f"unknown sample format {kind}")


def _decode(rate_out: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            rows = []
            for media in b.column(1).to_pylist():
                if media is None:
                    rows.append((None, None, None, None))
                    continue
                kind, rate, block, data = read_wav(media)
                pcm = resample(to_pcm(kind, data, block), rate, rate_out)
                rows.append((kind, rate, len(pcm), wav(pcm.astype("<i2").tobytes(), PCM, rate_out)))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True))], ["id", "kind", "rate", "n_samples", "pcm"])

    return run


def decode(media: DataFrame, id_col: str = "id", media_col: str = "media", rate_out: int = RATE_OUT) -> DataFrame:
    """WAV files of telephony kinds to resampled PCM files: id, kind, rate, n_samples, pcm."""
    return media.select(F.col(id_col).cast("long").alias("id"), F.col(media_col).alias("media")).mapInArrow(_decode(rate_out), "id long, kind int, rate int, n_samples long, pcm binary")


def _sums(pcm: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """Per stretch: root mean square and mean, rounded down, and peak."""
    x = pcm.astype(np.int64)
    squares, total, peak = np.add.reduceat(x * x, starts), np.add.reduceat(x, starts), np.maximum.reduceat(np.abs(x), starts)
    return [(int(np.sqrt(s / n)), int(t // n), int(p)) for s, t, p, n in zip(squares, total, peak, sizes, strict=True)]


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in blocks(batches, 2 << 20):
        texts = strings(b.column(1))
        media = [wav(t + b"\0" * (-len(t) % BLOCK or (0 if t else BLOCK))) for t in texts]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media: each whole text as mu-law samples of a WAV file, filled up to whole blocks with zeros."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_store, "doc_id long, n_bytes long, media binary")


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in blocks(batches, 2 << 20):
        back = [read_wav(m)[3] for m in b.column(2).to_pylist()]
        raw = np.frombuffer(b"".join(back), np.uint8)
        sizes = np.array([len(p) for p in back])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        ulaw = ULAW_PCM[raw]
        per_block = 2 * (BLOCK - 4) + 1
        u, a = _sums(ulaw, starts, sizes), _sums(ALAW_PCM[raw], starts, sizes)
        d = _sums(decode_adpcm(raw).ravel(), starts // BLOCK * per_block, sizes // BLOCK * per_block)
        pcm = [wav(resample(ulaw[s : s + n], RATE_IN, RATE_OUT).astype("<i2").tobytes(), PCM, RATE_OUT) for s, n in zip(starts, sizes, strict=True)]
        feature = [f"ulaw={x[0]}/{x[1]}/{x[2]};alaw={y[0]}/{y[1]}/{y[2]};adpcm={z[0]}/{z[1]}/{z[2]}" for x, y, z in zip(u, a, d, strict=True)]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(back, pa.binary()), pa.array(feature), pa.array(pcm, pa.binary())], ["doc_id", "n_bytes", "media", "payload", "feature", "pcm"])


def text_media(docs: DataFrame) -> DataFrame:
    """Stores texts as mu-law samples of a WAV file and reads the stored bytes back: doc_id, n_bytes, media, payload, feature, pcm.

    feature: root mean square, mean and peak of the samples expanded as mu-law and A-law and of the bytes decoded as
    ADPCM blocks. pcm: a WAV file of the mu-law signal at 16 kHz.
    """
    return store(docs).mapInArrow(_read_back, "doc_id long, n_bytes long, media binary, payload binary, feature string, pcm binary")
