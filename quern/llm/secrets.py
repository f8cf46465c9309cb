"""Secret scans through nested encodings, with every span mapped to the original text."""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_texts

#: Bytes of a compressed layer that are scanned at once. A larger one is scanned in blocks with an overlap, and reported.
LAYER_BYTES = 1 << 26
OVERLAP_BYTES = 1 << 20
#: Compressed bytes that are unwrapped at once.
_PIECE = 1 << 10

# The kinds of secrets in order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_LEAST = 6
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

# An escaped escape, escaped again and again: a long one is halved in a step, so that its layers are few.
_CHAIN_LEAST = 8
_CHAINS = (r"%(?:25|u0025)", r"\\(?:x5[cC]|u005[cC]|u\{0{0,4}5[cC]\}|U0000005[cC])", r"&(?:#0{0,5}38;|#[xX]0{0,4}26;)")
_CHAIN = "|".join(f"{unit}{{{_CHAIN_LEAST},}}+" for unit in _CHAINS)
_CHAIN_UNIT = re.compile("|".join(unit.split("(?:", 1)[1].removesuffix(")") for unit in _CHAINS))
_PERCENT = re.compile(
    rf"{_CHAIN}|"
    r"%[0-7][0-9A-Fa-f]|%[C-Dc-d][0-9A-Fa-f]%[89ABab][0-9A-Fa-f]"
    r"|%[Ee][0-9A-Fa-f](?:%[89ABab][0-9A-Fa-f]){2}|%[Ff][0-7](?:%[89ABab][0-9A-Fa-f]){3}"
)
_HIGH, _LOW = r"[dD][89abAB][0-9a-fA-F]{2}", r"[dD][c-fC-F][0-9a-fA-F]{2}"
_UNICODE = re.compile(
    rf"{_CHAIN}|\\u{_HIGH}\\u{_LOW}|[\\%]u[0-9a-fA-F]{{4}}|\\u\{{[0-9a-fA-F]{{1,6}}\}}|\\U[0-9a-fA-F]{{8}}|\\x[0-9a-fA-F]{{2}}"
    r"|&#[xX][0-9a-fA-F]{1,6};|&#[0-9]{1,7};"
)
_RUN_LEAST = 16
_STANDARD = str.maketrans("-_", "+/")
_PIECES = re.compile(r"[A-Za-z0-9+]{16,}={0,2}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{60,}+\r?\n)+[A-Za-z0-9+/_-]+={0,2}")


# No secret is shorter, and none gets shorter by an encoding.
_STRETCH = re.compile(rb"[\t-\r\x20-\x7e]{12,}")
_PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")

_ASSIGN_PARTS = (b"passw", b"secret", b"token", b"apikey", b"api_key")


def matches(text: str) -> list[tuple[str, int, int]]:
    """`kind, start, end` of the plain secrets in a text, by start and then kind."""
    found = []
    low = text.encode("utf-8", "surrogatepass").lower()
    if any(part in low for part in _ASSIGN_PARTS):  # much faster than the pattern, and few texts have any
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= _ASSIGN_LEAST]
    # A run is matched whole, so asking for its least length at once finds the same runs.
    found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return in_order(found)


def in_order(spans) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


class _Layer:
    """A decoded text; character i comes from the original's characters low[i] to high[i]."""

    def __init__(self, text: str, low: np.ndarray, high: np.ndarray):
        self.text, self.low, self.high = text, low, high

    @classmethod
    def root(cls, text: str) -> _Layer:
        at = np.arange(len(text), dtype=np.int64)
        return cls(text, at, at + 1)

    def key(self) -> tuple:
        digest = hashlib.sha256(self.text.encode("utf-8", "surrogatepass")).digest()
        return digest, int(self.low[0]), int(self.high[-1])

    def replaced(self, pattern: re.Pattern, decode) -> _Layer | None:
        """The whole layer with every match decoded, or None when nothing changes."""
        text, low, high, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            new = decode(m.group())
            if new is None:
                continue
            a, b = m.span()
            text += [self.text[at:a], new]
            low += [self.low[at:a], np.full(len(new), self.low[a])]
            high += [self.high[at:a], np.full(len(new), self.high[b - 1])]
            at = b
        if not text:
            return None
        tail = (self.text[at:], self.low[at:], self.high[at:])
        return _Layer("".join([*text, tail[0]]), np.concatenate([*low, tail[1]]), np.concatenate([*high, tail[2]]))

    def parts(self, start: int, end: int, data: bytes, ends: np.ndarray | None) -> list[_Layer]:
        """The layers that `data` holds; byte i of it ends at character ends[i] of start..end, or anywhere.

        One for each stretch that can hold a secret or an encoded one, a character for every byte: all that is
        looked for is ASCII.
        """
        found = []
        starts = None
        for m in _STRETCH.finditer(data):
            a, b = m.span()
            text = m.group().decode("ascii")
            if ends is None:
                low, high = np.broadcast_to(self.low[start], b - a), np.broadcast_to(self.high[end - 1], b - a)
            else:
                starts = np.r_[0, ends[:-1] - 1] if starts is None else starts
                low, high = self.low[start + starts[a:b]], self.high[start + ends[a:b] - 1]
            found.append(_Layer(text, low, high))
        return found


def _halved(chain: str) -> str | None:
    """A long chain of escapes without the first half of its levels; None for what is no such chain."""
    if len(chain) < 1 + 2 * _CHAIN_LEAST:  # no unit is shorter than two characters
        return None
    units = list(_CHAIN_UNIT.finditer(chain, 1))
    return chain[0] + chain[units[len(units) // 2].start() :]


def _percent(text: str) -> str | None:
    if (rest := _halved(text)) is not None:
        return rest
    try:
        return bytes.fromhex(text.replace("%", "")).decode()
    except UnicodeDecodeError:
        return None


def _escape(text: str) -> str | None:
    if (rest := _halved(text)) is not None:
        return rest
    pair = re.fullmatch(rf"\\u({_HIGH})\\u({_LOW})", text)
    if pair:
        return (bytes.fromhex(pair[1]) + bytes.fromhex(pair[2])).decode("utf-16-be")
    digits = text.strip("\\%&#;uUxX{}")
    code = int(digits, 10 if text[:2] == "&#" and text[2] not in "xX" else 16)
    return chr(code) if 0 < code < 0xD800 or 0xDFFF < code < 0x110000 else None


def _from_base64(run: str) -> Iterator[tuple[bytes, np.ndarray]]:
    """The bytes of a run at its four alignments, and after which of its characters each is complete."""
    run = run.rstrip("=")
    kept = np.flatnonzero(np.frombuffer(run.encode("ascii"), dtype=np.uint8) > ord("\r"))
    symbols = run.replace("\r", "").replace("\n", "").translate(_STANDARD)
    for skip in range(4):
        size = len(symbols) - skip
        size -= size % 4 == 1  # no byte ends with an odd symbol
        if size < _RUN_LEAST:
            return
        try:
            data = base64.b64decode(symbols[skip : skip + size] + "=" * (-size % 4), validate=True)
        except (binascii.Error, ValueError):
            continue
        byte = np.arange(len(data))
        yield data, kept[skip + np.minimum((byte * 8 + 7) // 6, size - 1)] + 1


def _members(data: memoryview) -> Iterator[bytes]:
    """Blocks of what compressed bytes hold, member after member, up to the first that isn't whole."""
    while len(data):
        head = bytes(data[:6])
        if head[:3] == b"\x1f\x8b\x08":
            stream = zlib.decompressobj(31)
        elif head[:2] in (b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda"):
            stream = zlib.decompressobj()
        elif head[:3] == b"BZh":
            stream = bz2.BZ2Decompressor()
        elif head == b"\xfd7zXZ\x00":
            stream = lzma.LZMADecompressor()
        elif head[:4] == b"\x28\xb5\x2f\xfd":
            import zstandard

            stream = zstandard.ZstdDecompressor().decompressobj()
        else:
            return
        at = 0
        while at < len(data) and not stream.eof:
            # Few bytes at once, as one may stand for tens of thousands.
            piece = data[at : at + _PIECE]
            at += len(piece)
            try:
                out = stream.decompress(piece)
            except Exception:  # each library has errors of its own
                return
            if out:
                yield out
        if not stream.eof:
            return
        data = data[at - len(stream.unused_data) :]


def _unpacked(data: bytes, most: int) -> Iterator[tuple[bytes, bool]]:
    """What the compressed streams in some bytes hold, in overlapping blocks of `most` bytes; and whether a block isn't all."""
    step = most - min(OVERLAP_BYTES, most // 4)
    for m in _PACKED.finditer(data):
        held = bytearray()
        for block in _members(memoryview(data)[m.start() :]):
            held += block
            while len(held) > most:
                yield bytes(held[:most]), True
                del held[:step]
        if held:
            yield bytes(held), False


def _contents(data: bytes, most: int) -> Iterator[tuple[bytes, bool]]:
    """What is compressed in some bytes, and what is compressed in that without another encoding between, once each."""
    seen, stack = set(), [_unpacked(data, most)]
    while stack:
        block, large = next(stack[-1], (None, False))
        if block is None:
            stack.pop()
            continue
        digest = hashlib.sha256(block).digest()
        if digest in seen:
            yield b"", large
            continue
        seen.add(digest)
        yield block, large
        stack.append(_unpacked(block, most))


def _below(layer: _Layer, most: int) -> Iterator[tuple[list[_Layer], bool]]:
    """The layers directly below one, and whether one is too large to be scanned at once."""
    text = layer.text
    if "%" in text:
        yield [layer.replaced(_PERCENT, _percent)], False
    if "\\" in text or "&#" in text or "%u" in text:
        yield [layer.replaced(_UNICODE, _escape)], False
    runs = [m.span() for m in _RUN.finditer(text)]
    if any(end - start >= 60 for start, end in runs):
        runs += [m.span() for m in _WRAPPED.finditer(text)]
    # What ends at a separator is decoded without what follows, too.
    runs += [
        (start + m.start(), start + m.end()) for start, end in runs for m in _PIECES.finditer(text[start:end]) if m.end() - m.start() < end - start
    ]
    for start, end in runs:
        for data, ends in _from_base64(text[start:end]):
            yield layer.parts(start, end, data, ends), False
            for block, large in _contents(data, most):
                yield layer.parts(start, end, block, None), large


def scan(text: str, most: int = LAYER_BYTES) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], bool]:
    """The plain spans of a text, all spans, and whether every layer was scanned.

    A stack unwraps layers until no new one comes up, so that one path of them is held. A layer already seen at the same place of the original
    isn't unwrapped again, so layers that hold themselves end.
    """
    plain = matches(text)
    if not text:
        return plain, plain, True
    spans, whole = set(plain), True
    work, seen = [_below(_Layer.root(text), most)], set()
    while work:
        layers, too_large = next(work[-1], (None, False))
        if layers is None:
            work.pop()
            continue
        whole &= not too_large
        deeper = []
        for layer in layers:
            if layer is None or not layer.text or (key := layer.key()) in seen:
                continue
            seen.add(key)
            deeper.append(_below(layer, most))
            spans.update((kind, int(layer.low[a]), int(layer.high[b - 1])) for kind, a, b in matches(layer.text))
        work += deeper
    return plain, in_order(spans), whole


def as_text(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = LAYER_BYTES) -> DataFrame:
    """`doc_id, n_assign, n_access, n_hex, base_sha256, spans, complete`: one row per document, no shuffle.

    Counts and the digest are of the plain spans; `spans` also has those found below URL, Unicode, base64 and
    compressed layers, as code points of the original. A span found below a compressed layer is that of the whole
    layer. Null texts are empty and have no spans. `complete` is false when a compressed layer holds more than
    `most` bytes: it is scanned in blocks, and what is longer than their overlap may be missed. No text is cut. Repeated rows and other columns don't matter.
    """
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "complete"]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.bool_()]

    def run(batches):
        for batch in batches:
            rows = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                plain, spans, whole = scan(value or "", most)
                counts = [sum(s[0] == kind for s in plain) for kind in KINDS]
                rows.append((key, *counts, hashlib.sha256(as_text(plain).encode()).hexdigest(), as_text(spans), whole))
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, complete boolean"
    return map_texts(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), run, schema)


def redact(docs: DataFrame, marker: str = "[SECRET]", text: str = "text", most: int = LAYER_BYTES) -> DataFrame:
    """`docs` with the columns it had, every secret span replaced by `marker`; overlapping spans become one.

    `n_chars`, if there is such a column, is the new number of code points. Texts without secrets and null
    texts stay as they are; no row is dropped.
    """

    def clean(batches):
        for batch in batches:
            names = batch.schema.names
            texts = [_redacted(t, marker, most) for t in batch.column(text).to_pylist()]
            columns = dict(zip(names, batch.columns, strict=True))
            columns[text] = pa.array(texts, columns[text].type)
            if "n_chars" in columns:
                sizes = [n if t is None else len(t) for n, t in zip(columns["n_chars"].to_pylist(), texts, strict=True)]
                columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return map_texts(docs, clean, docs.schema)


def _redacted(text: str | None, marker: str, most: int) -> str | None:
    if not text:
        return text
    out, at = [], 0
    for _, start, end in scan(text, most)[1]:
        if start >= at:
            out += [text[at:start], marker]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text
