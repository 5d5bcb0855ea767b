"""Media columns: MPEG audio.

``parse`` reads any MPEG-1/2/2.5 audio stream: ID3v2 and ID3v1 tags, frame
headers (resynchronised by skipping to the next header that another header or
the end confirms), Xing/Info and VBRI variable-bitrate tables, and the CRC-16 of
protected layer III frames.  It gives exact durations (samples over rate, rate by rate) and
the byte offset of every frame, for seeking.

``pack`` stores bytes losslessly in such a stream: an ID3v2 tag with the
payload's length and CRC-32 (a frame's own covers its header and side
information only), a Xing frame with its table, and protected MPEG-1 layer III
frames at 32 kHz mono whose main data carry the payload, each of the least
bitrate that holds what is left.  Where payload would be taken for an ID3v1 tag,
an empty one follows it.

Defined results: null bytes parse to null; bytes without a frame have none, a
zero duration and no offsets; a frame cut short ends the stream; a null text is
empty; equal texts give equal media; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections.abc import Iterator
from fractions import Fraction
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import by_bytes, table, text_of

# Fixed values of the format: kilobits a second by (MPEG-1, layer) and by (MPEG-2 and 2.5, layer), sampling rates, samples a frame.
BITRATES = {
    (1, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
SAMPLES = {(1, 1): 384, (1, 2): 1152, (1, 3): 1152, (2, 1): 384, (2, 2): 1152, (2, 3): 576}


def _crc_table() -> list[int]:
    out = []
    for byte in range(256):
        x = byte << 8
        for _ in range(8):
            x = (x << 1 ^ 0x8005 if x & 0x8000 else x << 1) & 0xFFFF
        out.append(x)
    return out


_CRC = _crc_table()


def crc16(data: bytes, start: int = 0xFFFF) -> int:
    for byte in data:
        start = (start << 8 & 0xFFFF) ^ _CRC[start >> 8 ^ byte]
    return start


class Frame:
    """A decoded frame header."""

    __slots__ = ("mpeg", "layer", "protected", "kbps", "rate", "size", "samples", "side")

    def __init__(self, mpeg: int, layer: int, protected: bool, kbps: int, rate: int, padding: int, mono: bool):
        self.mpeg, self.layer, self.protected, self.kbps, self.rate = mpeg, layer, protected, kbps, rate
        key = (1 if mpeg == 3 else 2, layer)
        self.samples = SAMPLES[key]
        self.size = (12 * kbps * 1000 // rate + padding) * 4 if layer == 1 else self.samples // 8 * kbps * 1000 // rate + padding
        self.side = ((17 if mono else 32) if mpeg == 3 else (9 if mono else 17)) if layer == 3 else 0


_SEEN: dict[int, Frame | None] = {}


def header(data: bytes, at: int) -> Frame | None:
    """The frame header at this place, or None; free-format and reserved values count as none."""
    if at + 4 > len(data) or data[at] != 0xFF or data[at + 1] & 0xE0 != 0xE0:
        return None
    key = int.from_bytes(data[at + 1 : at + 4], "big")
    if key not in _SEEN:
        b1, b2, b3 = data[at + 1 : at + 4]
        mpeg, layer, bits, rate = b1 >> 3 & 3, 4 - (b1 >> 1 & 3), b2 >> 4, b2 >> 2 & 3
        good = mpeg != 1 and layer != 4 and 0 < bits < 15 and rate != 3
        if len(_SEEN) > 100_000:
            _SEEN.clear()
        _SEEN[key] = Frame(mpeg, layer, not b1 & 1, BITRATES[1 if mpeg == 3 else 2, layer][bits - 1], RATES[mpeg][rate], b2 >> 1 & 1, b3 >> 6 == 3) if good else None
    return _SEEN[key]


def tags(data: bytes) -> tuple[dict[str, str], int, int]:
    """(tag texts, where audio starts, where it ends)."""
    out, start, end = {}, 0, len(data)
    if data[:3] == b"ID3" and len(data) >= 10:
        size = data[6] << 21 | data[7] << 14 | data[8] << 7 | data[9]
        start, at = min(10 + size, end), 10
        while at + 10 <= start and data[at]:
            name = data[at : at + 4].decode("latin-1")
            raw = data[at + 4 : at + 8]
            n = raw[0] << 21 | raw[1] << 14 | raw[2] << 7 | raw[3] if data[3] >= 4 else int.from_bytes(raw, "big")
            body = data[at + 10 : at + 10 + n]
            if name[0] == "T" and body:
                said = body[1:].decode({0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(body[0], "latin-1"), "replace").rstrip("\0")
                key, _, value = said.partition("\0") if name == "TXXX" else (name, "", said)
                out[f"TXXX:{key}" if name == "TXXX" else key] = value
            at += 10 + n
    if end - start >= 128 and data[end - 128 : end - 125] == b"TAG":
        old = data[end - 128 :]
        for name, a, b in (("TIT2", 3, 33), ("TPE1", 33, 63), ("TALB", 63, 93), ("TYER", 93, 97)):
            if said := old[a:b].split(b"\0")[0].decode("latin-1").strip():
                out.setdefault(name, said)
        end -= 128
    return out, start, end


def vbr_table(data: bytes, at: int, frame: Frame) -> dict[str, Any] | None:
    """The variable-bitrate table of the first frame: kind, frames, bytes, seek percentages or entries."""
    x = at + 4 + frame.side
    if data[x : x + 4] in (b"Xing", b"Info"):
        flags, y, out = int.from_bytes(data[x + 4 : x + 8], "big"), x + 8, {"kind": data[x : x + 4].decode(), "frames": None, "bytes": None, "toc": []}
        for bit, name in ((1, "frames"), (2, "bytes")):
            if flags & bit:
                out[name] = int.from_bytes(data[y : y + 4], "big")
                y += 4
        if flags & 4:
            out["toc"] = list(data[y : y + 100])
        return out
    x = at + 36
    if data[x : x + 4] == b"VBRI":
        size, frames, entries, scale, width, step = struct.unpack_from(">IIHHHH", data, x + 10)
        toc = [int.from_bytes(data[x + 26 + k * width : x + 26 + (k + 1) * width], "big") * scale for k in range(entries)]
        return {"kind": "VBRI", "frames": frames, "bytes": size, "toc": toc}
    return None


def parse(data: bytes) -> dict[str, Any]:
    """Tags, table, counts, exact duration and the offset of each audio frame (the table's own frame left out)."""
    said, at, end = tags(data)
    data = data[:end]
    out: dict[str, Any] = {"tags": said, "vbr": None, "frames": 0, "samples": 0, "rate": 0, "layer": 0, "skipped": 0, "crc_checked": 0, "crc_failed": 0, "min_kbps": 0, "max_kbps": 0, "offsets": []}
    offsets, rates, lasting = out["offsets"], set(), {}
    first, sure = True, False
    while at < end:
        frame = header(data, at)
        after = at + frame.size if frame else 0
        if frame is None or after > end or not (sure or after == end or header(data, after)):
            nearest = data.find(b"\xff", at + 1)
            out["skipped"] += (nearest if nearest > 0 else end) - at
            at, sure = (nearest if nearest > 0 else end), False
            continue
        sure = after < end and header(data, after) is not None
        if frame.protected and frame.layer == 3:
            out["crc_checked"] += 1
            out["crc_failed"] += crc16(data[at + 2 : at + 4] + data[at + 6 : at + 6 + frame.side]) != int.from_bytes(data[at + 4 : at + 6], "big")
        if first and frame.layer == 3:
            out["vbr"] = vbr_table(data, at, frame)
        if not (first and out["vbr"]):
            offsets.append(at)
            out["samples"] += frame.samples
            lasting[frame.rate] = lasting.get(frame.rate, 0) + frame.samples
            rates.add(frame.kbps)
        first = False
        out["rate"], out["layer"] = out["rate"] or frame.rate, out["layer"] or frame.layer
        at = after
    out["frames"] = len(offsets)
    out["min_kbps"], out["max_kbps"] = min(rates, default=0), max(rates, default=0)
    # exact, whatever the sampling rates
    out["duration_us"] = math.floor(sum((Fraction(n * 1_000_000, rate) for rate, n in lasting.items()), Fraction()))
    return out


# Storing bytes

RATE, SIDE = 32000, 17
SIZES = [144 * k * 1000 // RATE for k in BITRATES[1, 3]]
BODY = 4 + 2 + SIDE  # header, checksum and side information before a frame's main data
ID3V1 = b"TAG" + bytes(125)  # an empty tag


def _frame(bits: int, main: bytes, protected: bool = True) -> bytes:
    """A mono MPEG-1 layer III frame at 32 kHz of this bitrate index (from 0), with zero side information."""
    head = bytes([0xFF, 0xFA if protected else 0xFB, bits + 1 << 4 | 2 << 2, 0xC0])
    crc = struct.pack(">H", crc16(head[2:] + bytes(SIDE))) if protected else b""
    body = head + crc + bytes(SIDE) + main
    return body + bytes(SIZES[bits] - len(body))


_HEADS = [_frame(k, b"")[:BODY] for k in range(len(SIZES))]


def pack(payload: bytes) -> bytes:
    """The stream that stores ``payload``."""
    room = SIZES[-1] - BODY
    frames = []
    for at in range(0, len(payload), room):
        part = payload[at : at + room]
        bits = next(k for k, n in enumerate(SIZES) if n - BODY >= len(part))
        frames.append(_HEADS[bits] + part + bytes(SIZES[bits] - BODY - len(part)))
    said = b"\0payload\0%d/%08x" % (len(payload), zlib.crc32(payload))
    tag = b"TXXX" + struct.pack(">IH", len(said), 0) + said
    id3 = b"ID3\x03\0\0" + bytes([len(tag) >> s & 127 for s in (21, 14, 7, 0)]) + tag
    size = SIZES[4] + sum(map(len, frames))
    offsets, at = [], SIZES[4]
    for frame in frames:
        offsets.append(at)
        at += len(frame)
    toc = bytes(min(255, (offsets[k * len(offsets) // 100] if offsets else 0) * 256 // size) for k in range(100))
    table_ = b"Xing" + struct.pack(">III", 7, len(frames), size) + toc
    out = id3 + _frame(4, table_, False)[: SIZES[4]] + b"".join(frames)
    return out + ID3V1 if out[-128:-125] == b"TAG" else out


def unpack(data: bytes, found: dict[str, Any]) -> bytes:
    """The payload that ``pack`` stored, from the stream's own frames; ValueError where a checksum, the table or the payload's own CRC-32 doesn't fit."""
    size, crc = found["tags"]["TXXX:payload"].split("/")
    payload = b"".join(data[at + BODY : at + header(data, at).size] for at in found["offsets"])[: int(size)]
    if found["crc_failed"] or found["vbr"]["frames"] != found["frames"] or len(payload) != int(size) or zlib.crc32(payload) != int(crc, 16):
        raise ValueError("the stream isn't as it was stored")
    return payload


MEDIA = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])


def _store(unit: int):
    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, most=4 << 20):
            sizes, media = [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                payload = text + b" " * (-len(text) % unit if text else unit)
                sizes.append(len(text))
                media.append(pack(payload))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=["id", "n_bytes", "media"])

    return store


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: int = 192) -> DataFrame:
    """(id, n_bytes, media): each text in UTF-8, padded with spaces to a positive multiple of ``unit``, as an MPEG audio stream."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(_store(unit), T.StructType([rows.schema["id"], *MEDIA.fields]))


FEATURES = "tags map<string,string>, vbr string, vbr_frames long, frames long, samples long, rate int, duration_us long, min_kbps int, max_kbps int, skipped long, crc_checked long, crc_failed long, offsets array<long>"
_KINDS = pa.schema([("tags", pa.map_(pa.string(), pa.string())), ("vbr", pa.string()), ("vbr_frames", pa.int64()), ("frames", pa.int64()), ("samples", pa.int64()), ("rate", pa.int32()), ("duration_us", pa.int64()), ("min_kbps", pa.int32()), ("max_kbps", pa.int32()), ("skipped", pa.int64()), ("crc_checked", pa.int64()), ("crc_failed", pa.int64()), ("offsets", pa.list_(pa.int64()))])


def _row(found: dict[str, Any]) -> dict[str, Any]:
    vbr = found["vbr"] or {}
    return found | {"tags": list(found["tags"].items()), "vbr": vbr.get("kind"), "vbr_frames": vbr.get("frames")}


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "media", 4 << 20):
        rows = [_row(parse(m)) if m is not None else dict.fromkeys(_KINDS.names) for m in batch.column("media").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array([r[f.name] for r in rows], f.type) for f in _KINDS]], names=["id", *_KINDS.names])


def media_features(media: DataFrame, id_col: str = "id", media_col: str = "media") -> DataFrame:
    """(id, ...): what ``parse`` finds in each stream, as columns."""
    rows = media.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{media_col}`").alias("media"))
    return rows.mapInArrow(_features, f"id {rows.schema['id'].dataType.simpleString()}, {FEATURES}")


DIGEST = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, duration_us long, frames long"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "media", 4 << 20):
        rows = []
        for media in batch.column("media").to_pylist():
            found = parse(media)
            payload = unpack(media, found)
            seeks = zlib.crc32(struct.pack(f"<{len(found['offsets'])}Q", *found["offsets"]))
            feature = f"mpeg1 layer {found['layer']} {found['rate']} Hz {found['vbr']['kind']} frames={found['frames']} samples={found['samples']} kbps={found['min_kbps']}-{found['max_kbps']} crc_ok={found['crc_checked'] - found['crc_failed']} skipped={found['skipped']} seeks={seeks:08x}"
            rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature, found["duration_us"], found["frames"]))
        columns = list(zip(*rows, strict=True))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
        names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "duration_us", "frames"]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=["id", "n_bytes", *names])


def read_back(media: DataFrame) -> DataFrame:
    """Digests of (id, n_bytes, media) as ``store`` gives it: the stream is parsed and its payload taken out of its frames."""
    return media.mapInArrow(_digest, f"id {media.schema['id'].dataType.simpleString()}, n_bytes long, {DIGEST}")


def op9_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(store(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")
