"""Telephony audio in media columns: mu-law, A-law and IMA ADPCM bytes in WAV form, expanded, resampled and stored as PCM."""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakframe.llm.common import documents, row_map

#: WAV format codes, sampling rate in, and the frame that payloads are padded to.
PCM, ALAW, MULAW, IMA = 1, 6, 7, 17
RATE, FRAME = 8000, 576
#: Bytes of media that a task decodes at once; their samples, squares and PCM take about a hundred times as much.
DECODED_BYTES = 500_000
#: Bytes of an ADPCM block: 4 of header, 32 of two samples each.
BLOCK = 36
#: Bytes of a payload of more than DECODED_BYTES that are decoded at once: whole ADPCM blocks, whole samples.
WINDOW = BLOCK * 8192

# The IMA ADPCM step sizes and index changes.
STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], dtype=np.int32)
CHANGES = np.array([-1, -1, -1, -1, 2, 4, 6, 8], dtype=np.int32)


def mulaw_table() -> np.ndarray:
    u = ~np.arange(256, dtype=np.int32) & 0xFF
    size = (((u & 0x0F) << 3) + 0x84 << (u >> 4 & 7)) - 0x84
    return np.where(u & 0x80, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    a = np.arange(256, dtype=np.int32) ^ 0x55
    exponent, size = a >> 4 & 7, (a & 0x0F) << 4
    size = np.where(exponent == 0, size + 8, size + 0x108 << np.maximum(exponent - 1, 0))
    return np.where(a & 0x80, size, -size).astype(np.int16)


def adpcm_tables() -> tuple[np.ndarray, np.ndarray]:
    """By index * 16 + nibble: the change of the predictor, and the next index * 16."""
    step, nibble = STEPS[:, None], np.arange(16, dtype=np.int32)[None, :]
    size = (step >> 3) + (step >> 2) * (nibble & 1) + (step >> 1) * (nibble >> 1 & 1) + step * (nibble >> 2 & 1)
    after = np.clip(np.arange(89, dtype=np.int32)[:, None] + CHANGES[nibble & 7], 0, 88)
    return np.where(nibble & 8, -size, size).astype(np.int32).ravel(), (after * 16).astype(np.int32).ravel()


MU, A = mulaw_table(), alaw_table()
DELTA, NEXT = adpcm_tables()


def adpcm(blocks: np.ndarray) -> np.ndarray:
    """Samples of IMA ADPCM blocks (rows of bytes), decoded side by side: each step takes one nibble of every block."""
    n, width = blocks.shape
    out = np.empty((n, 1 + 2 * (width - 4)), dtype=np.int16)
    value = (blocks[:, 0].astype(np.int32) | blocks[:, 1].astype(np.int32) << 8).astype(np.int16).astype(np.int32)
    state = np.minimum(blocks[:, 2], 88).astype(np.int32) * 16
    out[:, 0] = value
    columns = np.ascontiguousarray(blocks[:, 4:].T).astype(np.int32)
    for k in range(width - 4):
        for half in (0, 1):
            at = state + (columns[k] >> 4 * half & 15)
            value = np.clip(value + DELTA[at], -32768, 32767)
            state = NEXT[at]
            out[:, 1 + 2 * k + half] = value
    return out


#: Half-band low-pass for doubling the rate: taps of the odd phase, a Blackman-windowed sinc that sums to 1.
TAPS = np.sinc(np.arange(-7.5, 8)) * np.blackman(18)[1:-1]
TAPS /= TAPS.sum()


def doubled(x: np.ndarray) -> np.ndarray:
    """16-bit PCM at twice the rate: the samples, and band-limited values half-way between."""
    return half_band(np.concatenate([np.repeat(x[:1], 7), x, np.repeat(x[-1:], 8)])) if len(x) else np.empty(0, dtype="<i2")


def padded(data: bytes, frame: int = FRAME) -> bytes:
    """The bytes, with 255 appended up to a positive multiple of the frame."""
    return data + b"\xff" * (-len(data) % frame or (0 if data else frame))


def wav(payload: bytes, code: int = MULAW, rate: int = RATE) -> bytes:
    """A mono WAV file of the payload as it is: samples of 8 bits, ADPCM blocks, or 16-bit PCM."""
    bits, align, extra = {PCM: (16, 2, b""), IMA: (4, BLOCK, struct.pack("<HH", 2, 1 + 2 * (BLOCK - 4)))}.get(code, (8, 1, struct.pack("<H", 0)))
    second = rate * align if code != IMA else rate * BLOCK // (1 + 2 * (BLOCK - 4))
    form = struct.pack("<HHIIHH", code, 1, rate, second, align, bits) + extra
    pad = b"\0" * (len(payload) % 2)
    return b"RIFF" + struct.pack("<I", 20 + len(form) + len(payload) + len(pad)) + b"WAVEfmt " + struct.pack("<I", len(form)) + form + b"data" + struct.pack("<I", len(payload)) + payload + pad


def opened(media: bytes) -> tuple[int, int, bytes]:
    """Format code, rate and payload of a WAV file; ValueError where it is none."""
    if media[:4] != b"RIFF" or media[8:16] != b"WAVEfmt ":
        raise ValueError("no WAV file")
    at, code, rate = 12, 0, 0
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack("<I", media[at + 4 : at + 8])[0]
        if name == b"fmt ":
            code, _, rate = struct.unpack("<HHI", media[at + 8 : at + 16])
        elif name == b"data":
            return code, rate, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data in the WAV file")


def expanded(payload: bytes, code: int) -> np.ndarray:
    """16-bit samples; a short last ADPCM block is left out."""
    raw = np.frombuffer(payload, dtype=np.uint8)
    if code == PCM:
        return raw[: len(raw) // 2 * 2].view("<i2")
    if code == IMA:
        return adpcm(raw[: len(raw) // BLOCK * BLOCK].reshape(-1, BLOCK)).ravel()
    return (A if code == ALAW else MU)[raw]


def measured(samples: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Root mean square, peak and sign changes of each stretch of samples; zeros of one without samples."""
    square = np.concatenate([[0], np.cumsum(samples.astype(np.int64) ** 2)])
    turns = np.concatenate([[0], np.cumsum(np.diff(np.signbit(samples).astype(np.int8)) != 0), [0]])
    a, b = bounds[:-1], bounds[1:]
    some = b > a
    peaks, rms, changes = np.zeros(len(a), dtype=np.int64), np.zeros(len(a)), np.zeros(len(a), dtype=np.int64)
    if some.any():
        peaks[some] = np.maximum.reduceat(np.abs(samples.astype(np.int32)), a[some])
        rms[some] = np.sqrt((square[b] - square[a])[some] / (b - a)[some])
        changes[some] = turns[b[some] - 1] - turns[a[some]]
    return [f"{r:.3f}/{p}/{t}" for r, p, t in zip(rms, peaks, changes, strict=True)]


class Meter:
    """What measured() says of one stretch, from windows of its samples in order."""

    def __init__(self):
        self.n = self.square = self.peak = self.turns = 0
        self.sign = None

    def add(self, samples: np.ndarray) -> None:
        if len(samples):
            negative = np.signbit(samples)
            self.n += len(samples)
            self.square += int((samples.astype(np.int64) ** 2).sum())
            self.peak = max(self.peak, int(np.abs(samples.astype(np.int32)).max()))
            self.turns += int(np.count_nonzero(negative[1:] != negative[:-1])) + (self.sign is not None and bool(negative[0]) != self.sign)
            self.sign = bool(negative[-1])

    def text(self) -> str:
        return f"{np.sqrt(np.float64(self.square) / max(1, self.n)):.3f}/{self.peak}/{self.turns}"


def windows(payload, code: int):
    """The samples of a payload, WINDOW bytes of it at a time."""
    for a in range(0, len(payload), WINDOW):
        yield expanded(payload[a : a + WINDOW], code)


def doubled_windows(parts):
    """doubled() of samples that come in windows: each keeps the 7 samples before it and waits for the 8 behind it."""
    held = None
    for x in parts:
        if not len(x):
            continue
        held = np.concatenate([np.repeat(x[:1], 7) if held is None else held, x])
        if len(held) > 15:
            yield half_band(held)
            held = held[-15:]
    if held is not None:
        yield half_band(np.concatenate([held, np.repeat(held[-1:], 8)]))


def half_band(context: np.ndarray) -> np.ndarray:
    """The samples of context but the first 7 and the last 8, and the values half-way behind each."""
    out = np.empty(2 * (len(context) - 15), dtype="<i2")
    out[0::2] = context[7:-8]
    out[1::2] = np.clip(np.rint(np.convolve(context.astype(np.float32), TAPS.astype(np.float32), "valid")), -32768, 32767)
    return out


def long_sound(payload, code: int, rate: int, keep: bool) -> tuple[list[str], int, bytearray | None]:
    """(measures as mu-law, A-law and ADPCM, CRC-32 of the PCM at twice the rate, the PCM as WAV if it is kept) of one payload, window by window: beside the PCM, memory does not grow with it."""
    meters = []
    for kind in (MULAW, ALAW, IMA):
        meters.append(Meter())
        for x in windows(payload, kind):
            meters[-1].add(x)
    size = 2 * sum(len(x) for x in windows(payload, code))
    head = wav(b"", PCM, 2 * rate)
    out, at, crc = bytearray(len(head) + 2 * size) if keep else None, len(head), 0
    if keep:  # as wav() does it; 16-bit samples need no byte behind them
        out[: len(head)] = head[:4] + struct.pack("<I", len(head) - 8 + 2 * size) + head[8:-4] + struct.pack("<I", 2 * size)
    for x in doubled_windows(windows(payload, code)):
        data = x.tobytes()
        crc = zlib.crc32(data, crc)
        if keep:
            out[at : at + len(data)] = data
            at += len(data)
    return [m.text() for m in meters], crc, out


def encode_media(df: DataFrame, text: str = "text", media: str = "media", frame: int = FRAME, code: int = MULAW) -> DataFrame:
    """df with the UTF-8 bytes of `text` as telephony samples in a WAV column. Null and empty texts are one frame of 255. An existing column `media` is replaced."""

    def make():
        return lambda values: [[wav(padded((v or "").encode(), frame), code) for v in values]]

    return row_map(df, text, make, [T.StructField(media, T.BinaryType())])


def decode_media(df: DataFrame, media: str = "media", pcm: str | None = "pcm") -> DataFrame:
    """df with what is read back from a telephony WAV column: payload digests, sizes, and features of the sound.

    `feature` has root mean square, peak and sign changes of the payload as mu-law, A-law and ADPCM, and the CRC-32 of its PCM at twice the rate.
    With `pcm` that PCM is stored too, as WAV. Null media and media that are no WAV file give nulls; a payload without samples has zeros, as has the ADPCM reading of one shorter than a block.
    A payload of more than DECODED_BYTES is decoded in windows, with the same values; its PCM, if stored, is the one thing that grows with it (four times its bytes). Equal media have equal features; repeated rows each keep their row; an empty df gives no rows. Columns of df that have the new names are replaced.
    """

    def make():
        def f(values):
            out = [[None] * len(values) for _ in range(6 + bool(pcm))]
            good = []

            def put(i: int, payload, code: int, rate: int, said: list[str], crc: int, sound) -> None:
                row = [hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(payload), len(values[i]), hashlib.sha256(values[i]).hexdigest(), f"mulaw={said[0]};alaw={said[1]};adpcm={said[2]};pcm{2 * rate}={crc:08x}"]
                for column, x in zip(out, row + [sound] * bool(pcm), strict=True):
                    column[i] = x

            for i, v in enumerate(values):
                try:
                    if v is None:
                        continue
                    code, rate, payload = opened(memoryview(v))
                except (ValueError, struct.error):
                    continue
                if len(payload) > DECODED_BYTES:
                    put(i, payload, code, rate, *long_sound(payload, code, rate, bool(pcm)))
                else:
                    good.append((i, code, rate, bytes(payload)))
            if not good:
                return out
            payloads = [x[3] for x in good]
            said = []
            for kind in (MULAW, ALAW, IMA):
                parts = [expanded(p, kind) for p in payloads] if kind != IMA else None
                if kind == IMA:
                    whole = [len(p) // BLOCK for p in payloads]
                    samples = expanded(b"".join(p[: n * BLOCK] for p, n in zip(payloads, whole, strict=True)), IMA)
                    sizes = [n * (1 + 2 * (BLOCK - 4)) for n in whole]
                else:
                    samples, sizes = np.concatenate(parts), [len(p) for p in parts]
                said.append(measured(samples, np.concatenate([[0], np.cumsum(sizes)])))
            for j, (i, code, rate, payload) in enumerate(good):
                sound = doubled(expanded(payload, code)).tobytes()
                put(i, payload, code, rate, [x[j] for x in said], zlib.crc32(sound), wav(sound, PCM, 2 * rate) if pcm else None)
            return out

        return f

    names = [("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("payload_bytes", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("feature", T.StringType())]
    return row_map(df, media, make, [T.StructField(n, t) for n, t in names] + ([T.StructField(pcm, T.BinaryType())] if pcm else []), most=DECODED_BYTES)


def op2_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, sizes, digests and features of every document as telephony, and `pcm`, its sound at 16 kHz as a WAV column. Null and empty texts are one frame of 255; equal texts have equal values; texts count whole."""
    stored = encode_media(documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "media")
    return decode_media(stored).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "pcm")
