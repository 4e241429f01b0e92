"""Secret scans: a worklist unwraps nested URL, Unicode, base64 and compressed layers until nothing new appears.

Every layer is scanned again and its findings are mapped to the code points of the document that they came from. URL and Unicode escapes are unwrapped a layer at a time for STEPS layers;
what is nested deeper is unwrapped to its end in one pass, so that a chain of thousands takes linear time. (No secret has a character that escapes are written with and that goes when
they are unwrapped, so what a layer between shows is part of what the last one shows.)
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import unicodedata
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakframe.llm.common import documents, row_map

KINDS = ("assign", "access", "hex")
#: The compressed layers of a text are opened up to this many bytes together; where they go on they are scanned so far and flagged in `truncated`.
MAX_LAYER_BYTES = 1 << 26
#: Compressed bytes that are opened at once.
PIECE = 256
#: Layers of URL and Unicode escapes that are unwrapped and scanned one by one.
STEPS = 8

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
CUE = re.compile("pass|secret|token|api", re.I | re.A)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
LONG_HEX = re.compile("[0-9a-f]{24}")
PERCENT = re.compile("(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|[＀-￯\U0001d400-\U0001d7ff]")
ESCAPED = re.compile(f"{PERCENT.pattern}|{ESCAPE.pattern}")
BASE64 = re.compile("[A-Za-z0-9+/_-]{16,}={0,2}")
#: Base64 in lines; the mark of a PEM's end is none.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:\r?\n[ \t]*+(?!-----)[A-Za-z0-9+/_-]++)+={0,2}")
LINE = re.compile("[A-Za-z0-9+/_-]+={0,2}")
#: What bytes that are not all text must have to be a layer: as much ASCII as the shortest secret, or mostly text.
READABLE = re.compile("[\x20-\x7e]{12}")
#: The same, in UTF-16 of either byte order.
UTF_16 = {"utf-16-le": re.compile(rb"(?:[\x09-\x0d\x20-\x7e]\x00){12}"), "utf-16-be": re.compile(rb"(?:\x00[\x09-\x0d\x20-\x7e]){12}")}
CONTROL = re.compile("[\x00-\x08\x0e-\x1f\x7f-\x9f\ufffd]")


def findings(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the secrets that stand in the text as it is."""
    out = []
    lower = text.lower()
    if "pass" in lower or "secret" in lower or "token" in lower or "api" in lower:
        out += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if LONG_HEX.search(text):
        out += [(2, m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return out


class Layer:
    """A text with, for each code point, where in the document it came from. A scalar origin holds for all code points; None is the document itself. `steps` counts escapes unwrapped since the last decoding."""

    __slots__ = ("depth", "first", "last", "steps", "text")

    def __init__(self, text, first=None, last=None, depth=0, steps=0):
        self.text, self.first, self.last, self.depth, self.steps = text, first, last, depth, steps

    def origin(self, a: int, b: int) -> tuple[int, int]:
        if self.first is None:
            return a, b
        if isinstance(self.first, int):
            return self.first, self.last
        return int(self.first[a]), int(self.last[b - 1])

    def key(self):
        """What tells a layer from one seen before: a digest of its text, and its place."""
        return (hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), *self.origin(0, len(self.text)))


def opener(data: bytes):
    """What makes a decompressor for the member that data begins with, or None."""
    if data[:2] == b"\x1f\x8b" or data[:1] == b"\x78" and len(data) > 2 and int.from_bytes(data[:2], "big") % 31 == 0:
        return lambda: zlib.decompressobj(47)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor
    if data[:6] == b"\xfd7zXZ\x00":
        return lambda: lzma.LZMADecompressor(memlimit=1 << 28)
    if data[:4] == b"\x28\xb5\x2f\xfd":
        import zstandard

        return lambda: zstandard.ZstdDecompressor().decompressobj()
    return None


def opened(d, piece: bytes, most: int) -> bytes:
    """What a decompressor gives for the next piece, more than `most` bytes only to tell that there are more."""
    if type(d).__module__.startswith("zstandard"):
        return d.decompress(piece)  # it has no limit; a piece gives some MB at most
    out = [d.decompress(piece, most + 1)]
    while len(out[-1]) and sum(map(len, out)) <= most and not d.eof and (getattr(d, "unconsumed_tail", b"") or not getattr(d, "needs_input", True)):
        out.append(d.decompress(getattr(d, "unconsumed_tail", b""), most + 1 - sum(map(len, out))))
    return b"".join(out)


def member(data: bytes, most: int) -> tuple[bytes, bool, bytes] | None:
    """The content of the gzip, zlib, zstandard, bzip2 or xz member that data begins with, whether it was cut, and the data behind it; or None.

    It is cut where `most` bytes were read, where it needs more memory than a worker gives it, and where it is damaged; what stands before is read as far as it can be.
    """
    if (make := opener(data)) is None:
        return None
    out, n, at, step, d, cut = [], 0, 0, PIECE, make(), False
    while at < len(data) and not d.eof and not cut:
        try:
            out.append(opened(d, data[at : at + step], most - n))
        except Exception as e:  # each library has its own
            if "limit" in str(e).lower() and isinstance(e, lzma.LZMAError):
                return b"".join(out), True, b""
            if step > 1:  # again as far as it went, then byte by byte
                d, step = make(), 1
                for i in range(0, at, PIECE):
                    opened(d, data[i : min(at, i + PIECE)], most)
                continue
            cut = True
            break
        at, n = at + step, n + len(out[-1])
        cut = n > most
    content = b"".join(out)[:most]
    if cut and n <= most and not READABLE.search(content.decode("utf-8", "replace")):
        return None  # damaged data is no layer, unless something can be read in it
    return content, cut, d.unused_data + data[at:] if d.eof else b""


def inflate(data: bytes, most: int) -> tuple[bytes, bool] | None:
    """The content of all members of gzip, zlib, zstandard, bzip2 or xz data, one behind the other, and whether it was cut, or None."""
    if (got := member(data, most)) is None:
        return None
    parts, n, cut = [got[0]], len(got[0]), got[1]
    while not cut and (rest := got[2].lstrip(b"\0")):  # zeros may pad members
        if n >= most:
            cut = member(rest, 1) is not None
            break
        if (got := member(rest, most - n)) is None:
            break
        parts.append(got[0])
        n, cut = n + len(got[0]), got[1]
    return b"".join(parts), cut


def as_text(data: bytes, most: int) -> tuple[str, bool, int] | None:
    """Text inside bytes (UTF-8, or UTF-16 and UTF-8), unpacked as often as they are compressed, with marks for what can't be decoded, whether it was cut, and how many bytes were unpacked; None where there is none."""
    cut, seen, n = False, set(), 0
    while data not in seen and (got := inflate(data, most - n)) is not None:
        seen.add(data)
        data, cut, n = got[0], cut or got[1], n + len(got[0])
    text = data.decode("utf-8", "replace")
    if b"\0" in data:
        for code, pattern in UTF_16.items():
            if m := pattern.search(data):
                return data[m.start() % 2 :].decode(code, "replace") + "\n" + text, cut, n
    if not cut and (not text or (not seen and not READABLE.search(text) and 4 * (len(text) - len(CONTROL.sub("", text))) > len(text))):
        return None
    return text, cut, n


def rewritten(layer: Layer) -> Layer | None:
    """The layer with each run of escapes replaced by what it stands for, or None where there is none."""
    text, parts, first, last, at, changed = layer.text, [], [], [], 0, False
    for m in ESCAPED.finditer(text):
        if (new := from_percent(m[0]) if m[0][0] == "%" else from_escape(m[0])) is None or not new[0]:
            continue
        changed = True
        parts += [text[at : m.start()], new[0]]
        begin = m.start() + np.concatenate([[0], np.cumsum(new[1])])
        first += [np.arange(at, m.start()), begin[:-1]]
        last += [np.arange(at, m.start()) + 1, begin[1:]]
        at = m.end()
    if not changed:
        return None
    parts.append(text[at:])
    first, last = np.concatenate([*first, np.arange(at, len(text))]).astype(np.int64), np.concatenate([*last, np.arange(at, len(text)) + 1]).astype(np.int64)
    if isinstance(layer.first, int):
        return Layer("".join(parts), layer.first, layer.last, layer.depth + 1, layer.steps + 1)
    if layer.first is not None:
        first, last = layer.first[first], layer.last[last - 1]
    return Layer("".join(parts), first, last, layer.depth + 1, layer.steps + 1)


HEX_VALUE = {ord(c): int(c, 16) for c in "0123456789abcdefABCDEF"}
#: Bytes that are no ASCII stand in a settling text as code points from here on until they make a character.
BYTE = 0xDC00


def compatible(c: int) -> bool:
    return 0xFF00 <= c <= 0xFFEF or 0x1D400 <= c <= 0x1D7FF


def ending(out: array) -> tuple[int, str] | None:
    """What the last code points of `out` stand for if they are an escape that the last one ends: how many they are, and the text."""
    c, n = out[-1], len(out)
    if c in HEX_VALUE:
        for size, head, digits in ((3, "%", 2), (4, "\\x", 2), (6, "\\u", 4), (10, "\\U", 8)):
            if n >= size and out[-size] == ord(head[0]) and (len(head) == 1 or out[1 - size] == ord(head[1])):
                code = 0
                for d in out[-digits:]:
                    if d not in HEX_VALUE:
                        break
                    code = code * 16 + HEX_VALUE[d]
                else:
                    if digits == 2:
                        return size, chr(code if code < 0x80 else BYTE + code)
                    if 0xDC00 <= code < 0xE000:  # the low half of a pair, behind its high half
                        if n > size and 0xD800 <= out[-size - 1] < 0xDC00:
                            return size + 1, chr(0x10000 + ((out[-size - 1] - 0xD800) << 10) + code - 0xDC00)
                        return None
                    return (size, chr(code)) if 0 < code < 0x110000 else None
    elif c == 0x7D or c == 0x3B:  # } or ;
        tail = "".join(map(chr, out[-12:]))
        m = re.search(r"(?:\\u\{([0-9A-Fa-f]{1,6})\}|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});)\Z", tail)
        if m:
            code = int(m[3]) if m[3] else int(m[1] or m[2], 16)
            return (len(m[0]), chr(code)) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else None
    elif BYTE + 0x80 <= c < BYTE + 0x100:
        for size in (2, 3, 4):
            if n >= size and BYTE + 0xC0 <= out[-size] < BYTE + 0x100:
                try:
                    return size, bytes(x - BYTE for x in out[-size:] if x >= BYTE).decode("utf-8")
                except (UnicodeDecodeError, ValueError):
                    return None
    elif compatible(c) and (text := unicodedata.normalize("NFKC", chr(c))) != chr(c):
        return 1, text
    return None


def settled(layer: Layer) -> Layer | None:
    """The layer with its escapes unwrapped until none is left, in one pass: each code point is put behind those before it, and as long as they end in an escape, what it stands for takes its place."""
    one = layer.first is None or not isinstance(layer.first, int)
    out, first, last, changed = array("I"), array("q"), array("q"), False
    starts = layer.first if one and layer.first is not None else range(len(layer.text))
    ends = layer.last if one and layer.first is not None else range(1, len(layer.text) + 1)
    for c, a, b in zip(map(ord, layer.text), starts, ends, strict=True):
        todo = [(c, a, b)]
        while todo:
            x, a, b = todo.pop()
            out.append(x)
            if one:
                first.append(a)
                last.append(b)
            if (x in HEX_VALUE or x > 0x7E or x == 0x7D or x == 0x3B) and (got := ending(out)) is not None:
                changed = True
                size, text = got
                if one:
                    a, b = first[-size], last[-1]
                    del first[-size:], last[-size:]
                del out[-size:]
                todo += [(ord(y), a, b) for y in reversed(text)]
    if not changed:
        return None
    text = re.sub("[\ud800-\udfff]", "\ufffd", out.tobytes().decode("utf-32-le", "surrogatepass"))
    if not one:
        return Layer(text, layer.first, layer.last, layer.depth + 1, layer.steps + 1)
    return Layer(text, np.frombuffer(first, dtype=np.int64), np.frombuffer(last, dtype=np.int64), layer.depth + 1, layer.steps + 1)


def from_percent(run: str):
    text = bytes.fromhex(run.replace("%", "")).decode("utf-8", "surrogateescape")  # a surrogate for each byte that can't be decoded
    sizes = [3 if "\ud800" <= c <= "\udfff" else 3 * len(c.encode()) for c in text]
    text = re.sub("[\ud800-\udfff]", "\ufffd", text)
    return None if not text.strip("\ufffd") else (text, sizes)


def wrapped(text: str):
    """(start, end, base64) of runs of lines of equal width, the last one maybe shorter."""
    for m in WRAPPED.finditer(text):
        lines = [(m.start() + x.start(), m.start() + x.end()) for x in LINE.finditer(m[0])]
        width, i = [b - a for a, b in lines], 0
        while i < len(lines):
            j = i + 1
            while j < len(lines) and width[j] == width[i]:
                j += 1
            end = j + (j < len(lines) and width[j] < width[i])
            if end - i > 1 and width[i] >= 16:
                yield lines[i][0], lines[end - 1][1], "".join(text[a:b] for a, b in lines[i:end])
            i = j


def from_escape(run: str):
    if run[:2] == "\\u" and run[2] != "{":
        units = [run[i + 2 : i + 6] for i in range(0, len(run), 6)]
        text = bytes.fromhex("".join(units)).decode("utf-16-be", "replace")
        sizes = [6 * (1 + (c > "￿")) for c in text]
        return (text, sizes) if sum(sizes) == len(run) else (text, [len(run), *[0] * (len(text) - 1)])
    if run[:2] == "\\x":
        data = bytes.fromhex(run.replace("\\x", ""))
        try:
            text = data.decode("utf-8")
            return text, [4 * len(c.encode()) for c in text]
        except UnicodeDecodeError:
            return data.decode("latin-1"), [4] * len(data)
    if len(run) == 1:
        text = unicodedata.normalize("NFKC", run)
        return None if text == run else (text, [1, *[0] * (len(text) - 1)])
    code = int(run[2:-1], 10) if run[:2] == "&#" and run[2] not in "xX" else int(run.strip("\\&#;xXuU{}"), 16)
    if not 0 < code < 0x110000 or 0xD800 <= code < 0xE000:
        return None
    return chr(code), [len(run)]


def decoded(run: str, most: int) -> tuple[str, bool, int] | None:
    """The text that base64, or a run of percent escapes of compressed bytes, hides, as as_text gives it; or None."""
    if run[0] == "%":
        return as_text(bytes.fromhex(run.replace("%", "")), most)
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        body = body[:-1]
    try:
        return as_text(base64.b64decode(body + "=" * (-len(body) % 4), validate=True), most)
    except (binascii.Error, ValueError):
        return None


#: A stretch is known to hide a layer once so many bytes of it are unpacked.
PEEK = 64


def unwrapped(layer: Layer) -> Layer | None:
    """The layer with its escapes unwrapped, or None where it has none."""
    text = layer.text
    if "%" in text or "\\" in text or "&#" in text or not text.isascii():
        return rewritten(layer) if layer.steps < STEPS else settled(layer)
    return None


def hiding(layer: Layer):
    """(stretch, start, end) of what hides a layer: base64, over lines or not, and compressed bytes in percent escapes; where it stands in the document."""
    text = layer.text
    if "%" in text:
        for m in PERCENT.finditer(text):
            if inflate(bytes.fromhex(m[0].replace("%", "")), PEEK):
                yield m[0], *layer.origin(m.start(), m.end())
    whole, k = [], 0
    for start, end, run in wrapped(text) if "\n" in text else ():
        if decoded(run, PEEK) is not None:
            yield run, *layer.origin(start, end)
            if len(text[start:end].split("\n", 1)[0].rstrip("\r")) % 4 == 0:
                whole.append((start, end))  # its lines have nothing of their own
    for m in BASE64.finditer(text):
        while k < len(whole) and whole[k][1] <= m.start():
            k += 1
        if (k == len(whole) or m.start() < whole[k][0]) and decoded(m[0], PEEK) is not None:
            yield m[0], *layer.origin(m.start(), m.end())


def scan_layers(text: str, most: int = MAX_LAYER_BYTES) -> tuple[list[tuple[int, int, int, int]], int, list[tuple[int, int]]]:
    """(start, kind, end, depth of the shallowest layer that shows it) of all findings in order, how many layers there are, the stretches (start, end) whose layers were cut.

    The worklist holds stretches, which are opened when their turn comes, so that one layer at a time is unpacked; all of a text share `most` bytes of unpacked data.
    """
    work: list = [Layer(text)]
    seen, found, layers, cut = {work[0].key()}, {}, 0, set()
    while work:
        layer = work.pop()
        if isinstance(layer, tuple):
            run, a, b, depth = layer
            if (got := decoded(run, most)) is None:
                continue
            most -= got[2]
            if got[1]:
                cut.add((a, b))
            layer = Layer(got[0], a, b, depth)
            if not layer.text or (key := layer.key()) in seen:
                continue
            seen.add(key)
        layers += 1
        for kind, a, b in findings(layer.text):
            k = (layer.origin(a, b)[0], kind, layer.origin(a, b)[1])
            found[k] = min(found.get(k, layer.depth), layer.depth)
        work += [(*x, layer.depth + 1) for x in hiding(layer)]
        if (below := unwrapped(layer)) is not None and below.text and (key := below.key()) not in seen:
            seen.add(key)
            work.append(below)
    return [(*k, d) for k, d in sorted(found.items())], layers, sorted(cut)


def scan(text: str, most: int = MAX_LAYER_BYTES) -> tuple[list[tuple[int, int, int, int]], int, bool]:
    """The findings and the number of layers as scan_layers gives them, and whether a layer was cut."""
    spans, layers, cut = scan_layers(text, most)
    return spans, layers, bool(cut)


def redact(text: str, spans: list[tuple[int, int]], mark: str = "[REDACTED]") -> str:
    """The text with the union of the spans replaced, each piece by one mark."""
    out, at = [], 0
    for a, b in sorted(spans):
        if b <= at:
            continue
        if a > at or not out:
            out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("end", T.IntegerType()), T.StructField("depth", T.IntegerType())]))


def scan_secrets(df: DataFrame, text: str = "text", max_layer_bytes: int = MAX_LAYER_BYTES, redacted: str | None = None) -> DataFrame:
    """df with secret_spans (start, kind, end, depth; depth 0 stands in the text itself), n_layers and truncated; with `redacted`, a column of that name has the text without them, and without the encoded stretches whose layers were cut.

    Null and empty texts have no spans, one layer, and null or empty redacted text. Repeated rows each keep their row; equal texts have equal findings. Columns of df that have these names are replaced.
    Very long texts count whole, in time that grows with their length; memory: one text, its stretches, and one unpacked layer at a time, of `max_layer_bytes` together for a text.
    """

    def make():
        def f(values):
            got = [scan_layers(v or "", max_layer_bytes) for v in values]
            out = [[[{"start": s, "kind": KINDS[k], "end": e, "depth": d} for s, k, e, d in x[0]] for x in got], [x[1] for x in got], [bool(x[2]) for x in got]]
            return out + ([[v if v is None else redact(v, [(s, e) for s, _, e, _ in x[0]] + x[2]) for v, x in zip(values, got, strict=True)]] if redacted else [])

        return f

    fields = [T.StructField("secret_spans", SPANS), T.StructField("n_layers", T.IntegerType()), T.StructField("truncated", T.BooleanType())]
    return row_map(df, text, make, fields + ([T.StructField(redacted, T.StringType())] if redacted else []))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts and digest of the secrets in each document as it is, and the spans of all layers. Null and empty texts have none; equal texts have equal findings; repeated rows each keep their row; very long texts count whole, as `scan_secrets` says."""
    found = scan_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("secret_spans", lambda x: x["depth"] == 0)
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secret_spans")).alias("spans"), "n_layers", "truncated")
