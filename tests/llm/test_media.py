import hashlib
import random
import zlib

import numpy as np
import pytest

from reelforge.llm import media, queries
from tests.llm.helpers import documents, words


def test_tables_hold_the_standard_values():
    assert media.ULAW_PCM[0xFF] == 0 and media.ULAW_PCM[0x00] == -32124 and media.ULAW_PCM[0x80] == 32124
    assert media.ALAW_PCM[0xD5] == 8 and media.ALAW_PCM[0x55] == -8 and media.ALAW_PCM[0xAA] == 32256 and media.ALAW_PCM[0x2A] == -32256
    assert len(set(media.ALAW_PCM.tolist())) == 256


def scalar_adpcm(block):
    value, index = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
    out = [value]
    for byte in block[4:]:
        for code in (byte & 15, byte >> 4):
            step = int(media.IMA_STEPS[index])
            delta = (step >> 3) + (step >> 2) * (code & 1) + (step >> 1) * (code >> 1 & 1) + step * (code >> 2 & 1)
            value = max(-32768, min(32767, value - delta if code & 8 else value + delta))
            index = max(0, min(88, index + int(media.IMA_MOVES[code & 7])))
            out.append(value)
    return out


def test_adpcm_against_a_scalar_decoder():
    data = random.Random(1).randbytes(64 * 20)
    got = media.decode_adpcm(np.frombuffer(data, np.uint8))
    assert got.tolist() == [scalar_adpcm(data[k : k + 64]) for k in range(0, len(data), 64)]


def test_wav_round_trip_and_resampling():
    for kind, payload in ((media.ULAW, b"abc"), (media.ALAW, b"abcd"), (media.PCM, b"\0\1"), (media.ADPCM, bytes(64))):
        assert media.read_wav(media.wav(payload, kind))[::3] == (kind, payload)
    with pytest.raises(ValueError):
        media.read_wav(b"nothing")
    assert media.resample(np.array([0, 10, -10], np.int16), 8000, 16000).tolist() == [0, 5, 10, 0, -10, -10]
    assert media.resample(np.arange(8, dtype=np.int16), 16000, 8000).tolist() == [0, 2, 4, 6]


def test_decode_and_store_pcm(spark):
    rows = [(1, media.wav(bytes(range(256)), media.ULAW)), (2, None), (3, media.wav(bytes(128), media.ADPCM))]
    got = {r["id"]: r for r in media.decode(spark.createDataFrame([(i, m if m is None else bytearray(m)) for i, m in rows], "id long, media binary"), rate_out=8000).collect()}
    assert np.frombuffer(media.read_wav(bytes(got[1]["pcm"]))[3], "<i2").tolist() == media.ULAW_PCM.tolist()
    assert got[2]["pcm"] is None and got[3]["n_samples"] == 2 * 121


def test_lower_rates_take_the_mean():
    assert media.resample(np.array([0, 4, 8, -8, 1000, 2000], np.int16), 24000, 8000).tolist() == [4, 997]
    assert media.resample(np.array([10, 20, 30], np.int16), 3, 2).tolist() == [(2 * 10 + 20) // 3, (20 + 2 * 30) // 3]
    assert media.resample(np.array([7], np.int16), 48000, 8000).tolist() == [7]
    tone = (10000 * np.sin(2 * np.pi * 7900 / 16000 * np.arange(1600))).astype(np.int16)  # above what 8 kHz holds
    assert np.abs(media.resample(tone, 16000, 8000)).max() < 0.1 * np.abs(tone[::2]).max() + 1


def test_text_payloads(spark, tmp_path):
    rows = [(1, words(random.Random(1), 100)), (2, ""), (3, "x" * 64), (4, "é" * 40), (5, "x" * 64), (6, None)]
    docs = documents(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op10_media_columns(spark, str(tmp_path)).collect()}
    whole = {r["doc_id"]: r for r in media.text_media(docs).collect()}
    for i, t in rows:
        b = (t or "").encode()
        p = b + bytes(-len(b) % 64 or (0 if b else 64))
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert r["media_bytes"] == len(media.wav(p)) and r["media_sha256"] == hashlib.sha256(media.wav(p)).hexdigest()
        ulaw = media.ULAW_PCM[list(p)]
        stored = bytes(whole[i]["pcm"])
        assert (r["pcm_bytes"], r["pcm_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())
        kind, rate, _, data = media.read_wav(stored)
        assert (kind, rate) == (media.PCM, 16000) and np.frombuffer(data, "<i2")[::2].tolist() == ulaw.tolist()
        forms = [ulaw, media.ALAW_PCM[list(p)], np.array([x for k in range(0, len(p), 64) for x in scalar_adpcm(p[k : k + 64])])]
        told = [f"{int(np.sqrt((x.astype(int) ** 2).sum() / len(x)))}/{int(x.astype(int).sum() // len(x))}/{int(np.abs(x.astype(int)).max())}" for x in forms]
        assert r["feature"] == "ulaw={};alaw={};adpcm={}".format(*told)
    assert got[3]["feature"] == got[5]["feature"] != got[1]["feature"]
