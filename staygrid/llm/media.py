"""Operator 1: media columns checked by signature sniffing.

An Aho-Corasick automaton finds every magic number of the known formats in one pass over a blob;
a validator of the format then follows its structure and lengths from there. What validates at
offset 0 corrects the declared type; what validates further in is carved out as embedded media.

Payloads are stored losslessly as 8-bit mono WAVE files and read back through the sniffer.

A pass over a blob takes time in proportion to its length, but for a logarithm, however many magic
numbers it holds: what a validator looks for beyond its own structure (a PDF's or a ZIP file's end) is
located once, by the same automaton; where chains of blocks, segments and chunks lead is remembered
for every place, whichever file began there (`Chains`); and check sums of long chunks are put together
from those of stretches. The exception is gzip, whose streams are read from each of its magic numbers.

Defined cases: a null or empty text is one block of blanks; a null blob has no type and no
parts; magic numbers without a valid structure are ignored; a PDF goes up to its last end mark
before another PDF begins; equal blobs give equal answers; extra columns are kept, but one with
the output's name is replaced; no rows give no rows.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import cache, cached_property

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.llm.common import materialize, tune, utf8

BLOCK, RATE = 192, 8000


class Chains:
    """Where a chain of steps from a place ends, each place walked once: step(place) is (True, next place) or (False, result)."""

    def __init__(self, step: Callable[[int], tuple[bool, int | None]]):
        self.step, self.known = step, {}

    def end(self, place: int) -> int | None:
        path = []
        while place not in self.known:
            path.append(place)
            goes_on, place = self.step(place)
            if not goes_on:
                result = place
                break
        else:
            result = self.known[place]
        self.known.update(dict.fromkeys(path, result))
        return result


class Blob:
    """Bytes, where the end marks in them are, and what validators have learned of them."""

    def __init__(self, data: bytes, marks: dict[bytes, list[int]]):
        self.data, self.view, self.marks = data, memoryview(data), marks
        self.chains = {"gif blocks": Chains(self._gif_block), "gif": Chains(self._gif_record), "jpeg": Chains(self._jpeg_segment), "png": Chains(self._png_chunk)}
        self.jumps: dict[tuple[int, int], tuple[int, bool]] = {}

    def __len__(self) -> int:
        return len(self.data)

    def __getitem__(self, at: int | slice) -> int | bytes:
        return self.data[at]

    def next(self, mark: bytes, begin: int) -> int:
        """The first place of `mark` from `begin` on, -1 if there is none."""
        places = self.marks.get(mark, [])
        k = bisect_left(places, begin)
        return places[k] if k < len(places) else -1

    def last(self, mark: bytes, begin: int, end: int) -> int:
        """The last place of `mark` from `begin` on and before `end`."""
        places = self.marks.get(mark, [])
        k = bisect_left(places, end) - 1
        return places[k] if k >= 0 and places[k] >= begin else -1

    # --- GIF ---

    def _gif_block(self, place: int) -> tuple[bool, int]:
        return (True, place + self.data[place] + 1) if place < len(self) and self.data[place] else (False, place + 1)

    def _gif_record(self, place: int) -> tuple[bool, int | None]:
        if place >= len(self):
            return False, None
        kind = self.data[place]
        if kind == 0x21:
            return True, self.chains["gif blocks"].end(place + 2)
        if kind == 0x2C and place + 10 <= len(self):
            return True, self.chains["gif blocks"].end(place + 11 + (3 << (self.data[place + 9] & 7) + 1 if self.data[place + 9] & 0x80 else 0))
        return False, place + 1 if kind == 0x3B else None

    # --- JPEG ---

    @cached_property
    def jpeg_marks(self) -> np.ndarray:
        """Where markers other than stuffed bytes and restarts begin."""
        raw = np.frombuffer(self.data, np.uint8)
        first, second = raw[:-1], raw[1:]
        return np.flatnonzero((first == 0xFF) & (second != 0) & ~((second >= 0xD0) & (second <= 0xD7)))

    def _jpeg_segment(self, place: int) -> tuple[bool, int | None]:
        if place + 4 > len(self) or self.data[place] != 0xFF:
            return False, None
        kind = self.data[place + 1]
        place += 2 + struct.unpack_from(">H", self.data, place + 2)[0]
        if kind != 0xDA:
            return True, place
        k = int(np.searchsorted(self.jpeg_marks, place))
        if k == len(self.jpeg_marks):
            return False, None
        place = int(self.jpeg_marks[k])
        return (False, place + 2) if self.data[place + 1] == 0xD9 else (True, place)

    # --- PNG ---

    @cached_property
    def _sums(self) -> list[int]:
        """CRC-32 of the bytes before every multiple of STRETCH."""
        out = [0]
        for at in range(0, len(self), STRETCH):
            out.append(zlib.crc32(self.view[at : at + STRETCH], out[-1]))
        return out

    def _before(self, place: int) -> int:
        k = place // STRETCH
        return zlib.crc32(self.view[k * STRETCH : place], self._sums[k])

    def crc32(self, begin: int, end: int) -> int:
        if end - begin <= 2 * STRETCH:
            return zlib.crc32(self.view[begin:end])
        return self._before(end) ^ _advanced(self._before(begin), end - begin)

    def _png_chunk(self, place: int) -> tuple[bool, int | None]:
        if place + 12 > len(self):
            return False, None
        size, name = _u32(self, place, ">"), self.data[place + 4 : place + 8]
        if place + 12 + size > len(self) or self.crc32(place + 4, place + 8 + size) != _u32(self, place + 8 + size, ">"):
            return False, None
        return name != b"IEND", place + 12 + size

    # --- RIFF ---

    def riff_jump(self, place: int, odd: int, level: int) -> tuple[int, bool]:
        """Where 2 ** level chunks lead from `place` in a file that begins at an odd or even place, and whether one is `data`."""
        key = (2 * place + odd, level)
        if key not in self.jumps:
            if place + 8 > len(self):
                self.jumps[key] = len(self) + 8, False
            elif level:
                middle, one = self.riff_jump(place, odd, level - 1)
                after, other = self.riff_jump(middle, odd, level - 1)
                self.jumps[key] = after, one or other
            else:
                after = place + 8 + _u32(self, place + 4)
                self.jumps[key] = after + ((after - odd) & 1), self.data[place : place + 4] == b"data"
        return self.jumps[key]


#: Bytes after which a blob's check sum is kept.
STRETCH = 1 << 13


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo CRC-32's, of reflected bits."""
    out, place = 0, 0x80000000
    while a:
        if a & place:
            out ^= b
            a ^= place
        place >>= 1
        b = b >> 1 ^ 0xEDB88320 if b & 1 else b >> 1
    return out


@cache
def _power(k: int) -> int:
    """x ** (8 * 2 ** k) modulo CRC-32's polynomial."""
    return _times(_power(k - 1), _power(k - 1)) if k else 0x00800000


def _advanced(crc: int, n: int) -> int:
    """What a CRC-32 contributes n bytes later: times x ** (8 n)."""
    for k in range(n.bit_length()):
        if n >> k & 1:
            crc = _times(crc, _power(k))
    return crc


def _u32(data: Blob | bytes, at: int, order: str = "<") -> int:
    raw = data.data if isinstance(data, Blob) else data
    return struct.unpack_from(order + "I", raw, at)[0] if at + 4 <= len(raw) else -1


def _riff(data: Blob, at: int) -> tuple[str, int] | None:
    size = _u32(data, at + 4)
    if size < 4 or at + 8 + size > len(data):
        return None
    kind = {b"WAVE": "audio/wav", b"WEBP": "image/webp", b"AVI ": "video/avi"}.get(data[at + 8 : at + 12])
    place, end, samples, level = at + 12, at + 8 + size, False, 0
    if kind is None or kind == "audio/wav" and data[place : place + 4] != b"fmt ":
        return None
    while level >= 0:  # ever longer jumps as far as they don't lead too far, then shorter ones
        after, found = data.riff_jump(place, at & 1, level)
        if after <= end and place + 8 <= end:
            place, samples, level = after, samples or found, level + 1
        else:
            level -= 1
            while level >= 0 and data.riff_jump(place, at & 1, level)[0] > end:
                level -= 1
    return (kind, 8 + size) if place == end and (kind != "audio/wav" or samples) else None


def _png(data: Blob, at: int) -> tuple[str, int] | None:
    end = data.chains["png"].end(at + 8) if data[at + 8 : at + 16] == b"\0\0\0\rIHDR" else None
    return None if end is None else ("image/png", end - at)


def _gif(data: Blob, at: int) -> tuple[str, int] | None:
    if at + 13 > len(data):
        return None
    end = data.chains["gif"].end(at + 13 + (3 << (data[at + 10] & 7) + 1 if data[at + 10] & 0x80 else 0))
    return None if end is None else ("image/gif", end - at)


def _jpeg(data: Blob, at: int) -> tuple[str, int] | None:
    if data.next(b"\xff\xd9", at) < 0:
        return None
    end = data.chains["jpeg"].end(at + 2)
    return None if end is None else ("image/jpeg", end - at)


def _bmp(data: Blob, at: int) -> tuple[str, int] | None:
    size, first, head = _u32(data, at + 2), _u32(data, at + 10), _u32(data, at + 14)
    fits = size > 0 and at + size <= len(data) and head in (12, 40, 52, 56, 64, 108, 124) and 14 + head <= first <= size
    return ("image/bmp", size) if fits and not _u32(data, at + 6) else None


def _gzip(data: Blob, at: int) -> tuple[str, int] | None:
    reader = zlib.decompressobj(31)
    try:
        left = data.view[at:]
        while not reader.eof:
            if not left and not reader.unconsumed_tail:
                return None
            reader.decompress(left or reader.unconsumed_tail, 1 << 20)  # contents aren't kept
            left = reader.unconsumed_tail
    except zlib.error:
        return None
    return "application/gzip", len(data) - at - len(reader.unused_data)


def _pdf(data: Blob, at: int) -> tuple[str, int] | None:
    other = data.next(b"%PDF-", at + 5)
    end = data.last(b"%%EOF", at, other if other >= 0 else len(data))  # incremental updates add end marks
    return ("application/pdf", end + 5 - at) if end > 0 and data.last(b"startxref", at, end) >= 0 else None


def _zip(data: Blob, at: int) -> tuple[str, int] | None:
    end = data.next(b"PK\x05\x06", at)
    if end < 0 or end + 22 > len(data):
        return None
    size, start, note = struct.unpack_from("<IIH", data.data, end + 12)
    central = data[at + start : at + start + 4] == b"PK\x01\x02" and at + start + size == end
    return ("application/zip", end + 22 + note - at) if central and end + 22 + note <= len(data) else None


#: Magic numbers (fixed values) and what validates each.
FORMATS: dict[bytes, Callable[[Blob, int], tuple[str, int] | None]] = {
    b"RIFF": _riff,
    b"\x89PNG\r\n\x1a\n": _png,
    b"GIF87a": _gif,
    b"GIF89a": _gif,
    b"\xff\xd8\xff": _jpeg,
    b"BM": _bmp,
    b"\x1f\x8b\x08": _gzip,
    b"%PDF-": _pdf,
    b"PK\x03\x04": _zip,
}


#: Marks that validators look for (fixed values).
MARKS = (b"%%EOF", b"startxref", b"%PDF-", b"PK\x05\x06", b"\xff\xd9")


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for text in {*FORMATS, *MARKS}:
        found.add_word(text.decode("latin-1"), text)
    found.make_automaton()
    return found


def sniff(blob: bytes, machine: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """Offset, length and type of each valid part: the whole file first, then what is embedded."""
    marks: dict[bytes, list[int]] = {}
    starts = []
    for last, text in machine.iter(blob.decode("latin-1")):
        at = last - len(text) + 1
        if text in FORMATS:
            starts.append((at, FORMATS[text]))
        if text in MARKS:
            marks.setdefault(text, []).append(at)
    data, parts, within = Blob(blob, marks), [], 0
    for at, check in starts:
        if at < within or not (valid := check(data, at)):
            continue
        parts.append((at, valid[1], valid[0]))
        if at:  # inside the file at offset 0 more may be embedded; a carved part is taken whole
            within = at + valid[1]
    return parts


def wave(payload: bytes) -> bytes:
    """The payload as the samples of a mono 8-bit WAVE file."""
    pad = len(payload) & 1
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload) + pad, b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(payload))
    return head + payload + bytes(pad)


def samples(blob: bytes) -> bytes:
    """The samples of a WAVE file that `sniff` found valid."""
    place = 12
    while blob[place : place + 4] != b"data":
        place += 8 + _u32(blob, place + 4)
        place += place & 1
    return blob[place + 8 : place + 8 + _u32(blob, place + 4)]


def store_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, declared and media: each whole text as a WAVE file, in the shared folder.

    Files of texts that fill whole blocks are declared what they are, the others as octet streams.
    """

    def run(texts: pd.Series) -> pd.DataFrame:
        raw = [utf8(t) for t in texts]
        return pd.DataFrame({"n_bytes": [len(r) for r in raw], "media": [wave(r.ljust(max(-(-len(r) // BLOCK), 1) * BLOCK)) for r in raw]})

    tune(docs.sparkSession)
    stored = F.pandas_udf(run, "n_bytes long, media binary")(F.col("text").cast("string")).alias("stored")
    declared = F.when((F.col("stored.n_bytes") > 0) & (F.col("stored.n_bytes") % BLOCK == 0), "audio/wav").otherwise("application/octet-stream")
    made = docs.select(F.col("doc_id").cast("long"), stored).select("doc_id", "stored.n_bytes", "stored.media", declared.alias("declared"))
    return materialize(made, "media")


def sniff_media(rows: DataFrame, media: str = "media", output: str = "sniffed") -> DataFrame:
    """`rows` with a struct column `output`: type, n_embedded, embedded and payload.

    embedded lists offset:length:type of carved parts; payload holds a WAVE file's samples.
    """

    def run(blobs: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = automaton()
        for batch in blobs:
            out = []
            for blob in batch:
                parts = sniff(blob, machine) if blob is not None else []
                kind = parts[0][2] if parts and parts[0][0] == 0 else None
                inner = [f"{at}:{size}:{name}" for at, size, name in parts if at]
                out.append((kind, len(inner), ",".join(inner), samples(blob) if kind == "audio/wav" else None))
            yield pd.DataFrame(out, columns=["type", "n_embedded", "embedded", "payload"])

    tune(rows.sparkSession)
    return rows.withColumn(output, F.pandas_udf(run, "type string, n_embedded int, embedded string, payload binary")(F.col(media)))


def digests(rows: DataFrame) -> DataFrame:
    """The digest columns of stored texts that went through `sniff_media`."""
    payload = F.col("sniffed.payload")
    mean = F.col("n_bytes") / F.length(payload)
    return rows.select(
        "doc_id", "n_bytes", F.length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_sha256"),
        F.crc32(F.substring(payload, -16, 16)).alias("tail_crc32"), F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(";", F.concat(F.lit("type="), F.col("sniffed.type")), F.concat(F.lit("corrected="), (F.col("sniffed.type") != F.col("declared")).cast("string")),
                    F.concat(F.lit("embedded="), F.col("sniffed.embedded")), F.concat(F.lit("fill="), F.format_number(mean, 4))).alias("feature"),
    )
