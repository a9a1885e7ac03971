"""MPEG audio columns: write payloads as a valid stream, read any stream back.

``wrap`` stores bytes losslessly in an MPEG-1 Layer III stream: an ID3v2 tag, a
frame with the table of a variable bitrate, then frames without main data
whose ancillary bytes are the payload (players decode silence).  ``parse``
reads any MPEG audio: it follows frame headers, searches for the next
believable header at the start and after damage (one that another header of the
same kind follows), parses ID3 tags and the frame counts, byte counts and seek
tables of Xing, Info and VBRI headers, verifies the frames' CRC-16 in all three
layers and the tag's CRC-32, and gives exact durations in samples and the byte
offset of every frame.  An ID3v1 tag is one only where no frame is: frames are
followed to the end, and the last 128 bytes are looked at if none covers them.

Edge cases: null is the empty text, which is stored as 64 zero bytes; equal
texts give equal streams; bytes that hold no frame give zero frames and an
empty payload; a stream whose payload isn't the one that its tag tells has
``payload_ok`` false; texts are never cut; an empty table gives an empty table;
``with_media`` and ``with_audio`` replace a column of their output's name.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the standard: kbit/s by (MPEG-1?, layer), Hz by version.
BITRATES = {
    (True, 1): [0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448],
    (True, 2): [0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384],
    (True, 3): [0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320],
    (False, 1): [0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256],
    (False, 2): [0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160],
    (False, 3): [0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160],
}
RATES = {3: [44100, 48000, 32000], 2: [22050, 24000, 16000], 0: [11025, 12000, 8000]}
# Fixed values of the standard: bits of allocation by subband of layer II, tables B.2a to B.2d and that of low rates.
ALLOCATION = {
    "a": [4] * 11 + [3] * 12 + [2] * 4,
    "b": [4] * 11 + [3] * 12 + [2] * 7,
    "c": [4] * 2 + [3] * 6,
    "d": [4] * 2 + [3] * 10,
    "low": [4] * 4 + [3] * 7 + [2] * 19,
}

BLOCK = 64
RATE_INDEX, SAMPLE_RATE, PER_FRAME = 2, 32000, 1152
SIDE = 17  # side information of one channel in MPEG-1
BEFORE = 4 + 2 + SIDE + 2  # header, CRC, side information, and the length of the ancillary bytes


class Header:
    """The fields of one frame header."""

    __slots__ = ("version", "layer", "crc", "kbps", "rate", "length", "samples", "mono", "side", "bound")

    def __init__(self, word: bytes):
        version, layer = word[1] >> 3 & 3, 4 - (word[1] >> 1 & 3)
        first = version == 3
        self.version, self.layer, self.crc = version, layer, not word[1] & 1
        self.kbps = BITRATES[first, layer][word[2] >> 4]
        self.rate = RATES[version][word[2] >> 2 & 3]
        pad = word[2] >> 1 & 1
        self.mono = word[3] >> 6 == 3
        # the first subband that both channels of joint stereo share
        self.bound = ((word[3] >> 4 & 3) + 1) * 4 if word[3] >> 6 == 1 else 32
        self.samples = 384 if layer == 1 else 1152 if layer == 2 or first else 576
        self.length = (12 * self.kbps * 1000 // self.rate + pad) * 4 if layer == 1 else self.samples // 8 * self.kbps * 1000 // self.rate + pad
        self.side = ((17 if self.mono else 32) if first else (9 if self.mono else 17)) if layer == 3 else 0

    def like(self, other: Header | None) -> bool:
        """Whether another header may be of the same stream."""
        return other is not None and (self.version, self.layer, self.rate) == (other.version, other.layer, other.rate)

    def allocation(self) -> list[int]:
        """Bits of the allocation of each subband of a layer I or II frame."""
        if self.layer == 1:
            return [4] * 32
        if self.version != 3:
            return ALLOCATION["low"]
        each = self.kbps if self.mono else self.kbps / 2
        if each <= 48:
            return ALLOCATION["d" if self.rate == 32000 else "c"]
        return ALLOCATION["a" if self.rate == 48000 or each <= 80 else "b"]

    def guarded_bits(self, body: bytes) -> int:
        """How many bits of a frame's body its CRC covers."""
        if self.layer == 3:
            return 8 * self.side
        bits = int.from_bytes(body[:64].ljust(64, b"\0"), "big")
        at = select = 0
        for subband, width in enumerate(self.allocation()):
            for _ in range(1 if self.mono or subband >= self.bound else 2):
                used = bits >> 512 - at - width & (1 << width) - 1
                at += width
                # layer II goes on with 2 bits for each channel of a subband in use
                select += 2 * (used > 0) * (2 if subband >= self.bound and not self.mono else 1) if self.layer == 2 else 0
        return at + select


@lru_cache(4096)
def header(word: bytes) -> Header | None:
    """A parsed header, or None where the four bytes can't be one."""
    if len(word) < 4 or word[0] != 0xFF or word[1] & 0xE0 != 0xE0:
        return None
    if word[1] >> 3 & 3 == 1 or not word[1] >> 1 & 3 or word[2] >> 4 in (0, 15) or word[2] >> 2 & 3 == 3:
        return None
    return Header(word)


@lru_cache(4096)
def crc16(data: bytes, bits: int | None = None) -> int:
    """CRC-16 of the standard over the header's last two bytes and the first bits of the body."""
    crc = 0xFFFF
    for i in range(8 * len(data) if bits is None else min(bits, 8 * len(data))):
        top = (crc >> 15) ^ (data[i >> 3] >> 7 - (i & 7) & 1)
        crc = (crc << 1 ^ 0x8005 if top else crc << 1) & 0xFFFF
    return crc


def _head(kbps: int, crc: bool) -> bytes:
    index = BITRATES[True, 3].index(kbps)
    return bytes([0xFF, 0xFA if crc else 0xFB, index << 4 | RATE_INDEX << 2, 0xC0])


def _safe(n: int) -> bytes:
    return bytes(n >> s & 0x7F for s in (21, 14, 7, 0))


def _text_frame(name: bytes, text: bytes) -> bytes:
    body = b"\0" + text
    return name + struct.pack(">IH", len(body), 0) + body


@lru_cache(64)
def _frame_start(kbps: int) -> bytes:
    head = _head(kbps, True)
    return head + crc16(head[2:] + bytes(SIDE)).to_bytes(2, "big") + bytes(SIDE)


def _room(kbps: int) -> int:
    return PER_FRAME // 8 * kbps * 1000 // SAMPLE_RATE - BEFORE


def wrap(payload: bytes) -> bytes:
    """The payload as an MPEG stream."""
    full = _room(320)
    parts = [payload[i : i + full] for i in range(0, len(payload), full)] or [b""]
    frames = []
    for part in parts:
        kbps = next(k for k in BITRATES[True, 3][1:] if _room(k) >= len(part))
        frames.append(_frame_start(kbps) + len(part).to_bytes(2, "big") + part + bytes(_room(kbps) - len(part)))
    tag_frame = _head(64, False) + bytes(SIDE)
    size = PER_FRAME // 8 * 64000 // SAMPLE_RATE
    total = size + sum(map(len, frames))
    ends, at = [], size
    for f in frames:
        ends.append(at)
        at += len(f)
    toc = bytes(min(255, ends[len(frames) * i // 100] * 256 // total) for i in range(100))
    tag_frame += b"Xing" + struct.pack(">III", 15, len(frames), total) + toc + struct.pack(">I", 0)
    tag_frame += bytes(size - len(tag_frame))
    milliseconds = len(frames) * PER_FRAME * 1000 // SAMPLE_RATE
    tags = _text_frame(b"TLEN", str(milliseconds).encode()) + _text_frame(b"TXXX", b"payload_bytes\0" + str(len(payload)).encode())
    tags += _text_frame(b"TXXX", b"payload_crc32\0" + str(zlib.crc32(payload)).encode())
    return b"ID3\x03\0\0" + _safe(len(tags)) + tags + tag_frame + b"".join(frames)


def tags(data: bytes) -> tuple[dict[str, str], int]:
    """Text frames of an ID3v2 tag at the start, and where the audio begins."""
    if data[:3] != b"ID3" or len(data) < 10:
        return {}, 0
    size = data[6] << 21 | data[7] << 14 | data[8] << 7 | data[9]
    out, at, end = {}, 10, min(len(data), 10 + size)
    while at + 10 <= end and data[at] > 0:
        name = data[at : at + 4].decode("latin-1")
        n = struct.unpack(">I", data[at + 4 : at + 8])[0]
        if data[3] >= 4:
            n = (n >> 24 & 127) << 21 | (n >> 16 & 127) << 14 | (n >> 8 & 127) << 7 | n & 127
        body = data[at + 10 : min(end, at + 10 + n)]
        if name[0] == "T" and body:
            text = body[1:].decode({0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(body[0], "latin-1"), "replace")
            key, _, value = text.partition("\0") if name == "TXXX" else (name, "", text)
            out[key] = value.rstrip("\0")
        at += 10 + n
    return out, 10 + size


def _xing(data: bytes, at: int) -> dict:
    """Frames, bytes and seek offsets of a Xing or Info header."""
    (flags,), at = struct.unpack(">I", data[at : at + 4]), at + 4
    out = {"table_frames": -1, "table_bytes": -1, "table_seek": []}
    for bit, name in ((1, "table_frames"), (2, "table_bytes")):
        if flags & bit:
            out[name] = struct.unpack(">I", data[at : at + 4])[0]
            at += 4
    if flags & 4 and out["table_bytes"] >= 0:
        out["table_seek"] = [x * out["table_bytes"] // 256 for x in data[at : at + 100]]
    return out


def _vbri(data: bytes, at: int) -> dict:
    """The same of a VBRI header, whose table holds the bytes of each group of frames."""
    n_bytes, frames, entries, scale, size = struct.unpack(">IIHHH", data[at + 10 : at + 24])
    ends, total = [], 0
    for i in range(entries):
        cell = data[at + 26 + i * size : at + 26 + (i + 1) * size]
        if len(cell) < size:
            break
        total += int.from_bytes(cell, "big") * scale
        ends.append(total)
    return {"table_frames": frames, "table_bytes": n_bytes, "table_seek": ends}


def _table(data: bytes, at: int, body: int, after: int) -> dict | None:
    """The table that a first frame holds instead of sound, if it does."""
    mark = data[body : body + 4]
    if mark in (b"Xing", b"Info") and body + 8 <= after:
        return {"table": mark.decode(), **_xing(data[:after], body + 4)}
    if data[at + 36 : at + 40] == b"VBRI" and at + 62 <= after:
        return {"table": "VBRI", **_vbri(data[:after], at + 36)}
    return None


def parse(data: bytes) -> dict:
    """Frames, exact length, seek offsets, checksums and the payload of any MPEG audio bytes."""
    found, at = tags(data)
    end = len(data)
    old_tag = end - 128 if end >= 128 and data[-128:-125] == b"TAG" else end
    out = {"frames": 0, "samples": 0, "sample_rate": 0, "channels": 0, "version": 0, "layer": 0, "kbps_min": 0, "kbps_max": 0, "crc_ok": 0, "crc_bad": 0, "resyncs": 0, "skipped_bytes": 0, "table": "none", "table_frames": -1, "table_bytes": -1, "table_seek": [], "offsets": [], "duration_us": 0, "old_tag": False}
    payload, micros, good, lost = [], 0, False, False
    while at + 4 <= end:
        if at == old_tag:
            out["old_tag"] = True
            break
        h = header(data[at : at + 4])
        after = at + h.length if h else 0
        if not h or after > end or not good and after != old_tag and after + 4 <= end and not h.like(header(data[after : after + 4])):
            to = data.find(b"\xff", at + 1, end)
            to = end if to < 0 else to
            to = old_tag if at < old_tag < to else to
            out["resyncs"] += not lost
            out["skipped_bytes"] += to - at
            at, good, lost = to, False, True
            continue
        good, lost = True, False
        start = at + 4 + 2 * h.crc
        body = start + h.side
        if not out["frames"] and out["table"] == "none" and h.layer == 3:
            told = _table(data, at, body, after)
            if told:
                out |= told
                at = after
                continue
        if h.crc:
            guarded = data[start : min(after, start + 64)]
            right = int.from_bytes(data[at + 4 : at + 6], "big") == crc16(data[at + 2 : at + 4] + guarded[: h.side or 64], 16 + h.guarded_bits(guarded))
            out["crc_ok" if right else "crc_bad"] += 1
        if h.layer == 3 and not any(data[start:body]):
            n = int.from_bytes(data[body : body + 2], "big")
            payload.append(data[body + 2 : min(body + 2 + n, after)])
        out["kbps_min"] = min(out["kbps_min"] or h.kbps, h.kbps)
        out["kbps_max"] = max(out["kbps_max"], h.kbps)
        out |= {"sample_rate": h.rate, "channels": 1 if h.mono else 2, "version": {3: 10, 2: 20, 0: 25}[h.version], "layer": h.layer}
        out["frames"] += 1
        out["samples"] += h.samples
        micros += h.samples * 1_000_000 * 441 // h.rate  # in 1/441 microseconds: whole at every rate
        out["offsets"].append(at)
        at = after
    out["duration_us"] = micros // 441
    out["payload"] = b"".join(payload)
    said = found.get("payload_crc32")
    out["payload_ok"] = zlib.crc32(out["payload"]) == int(said) if said and said.isdigit() else None
    out["tags"] = found
    return out


PARSED = (
    "struct<payload:binary,payload_ok:boolean,tags:map<string,string>,frames:int,samples:bigint,duration_us:bigint,sample_rate:int,"
    "channels:int,version:int,layer:int,kbps_min:int,kbps_max:int,crc_ok:int,crc_bad:int,resyncs:int,skipped_bytes:bigint,"
    "table:string,table_frames:bigint,table_bytes:bigint,table_seek:array<bigint>,old_tag:boolean,offsets:array<bigint>>"
)
_TYPE = pa.struct(
    [("payload", pa.binary()), ("payload_ok", pa.bool_()), ("tags", pa.map_(pa.string(), pa.string())), ("frames", pa.int32()), ("samples", pa.int64()), ("duration_us", pa.int64()), ("sample_rate", pa.int32()), ("channels", pa.int32()), ("version", pa.int32()), ("layer", pa.int32()), ("kbps_min", pa.int32()), ("kbps_max", pa.int32()), ("crc_ok", pa.int32()), ("crc_bad", pa.int32()), ("resyncs", pa.int32()), ("skipped_bytes", pa.int64()), ("table", pa.string()), ("table_frames", pa.int64()), ("table_bytes", pa.int64()), ("table_seek", pa.list_(pa.int64())), ("old_tag", pa.bool_()), ("offsets", pa.list_(pa.int64()))]
)


def to_media(texts: pa.Array) -> pa.Array:
    """Stream of each text: its UTF-8 with zero bytes up to a positive multiple of 64."""
    out = []
    for x in texts.cast(pa.binary()):  # one text at a time is a Python object
        data = x.as_py() or b""
        out.append(wrap(data + bytes(-len(data) % BLOCK if data else BLOCK)))
    return pa.array(out, pa.binary())


def read_media(media: pa.Array) -> pa.Array:
    """Each stream as a PARSED struct; a null stream is an empty one."""
    rows = [parse(x.as_py() or b"") for x in media]
    for r in rows:
        r["tags"] = list(r["tags"].items())
    return pa.array(rows, _TYPE)


def with_media(df: DataFrame, text: str = "text", out: str = "media") -> DataFrame:
    """``df`` with the stored stream of a text column."""
    return df.withColumn(out, F.arrow_udf(to_media, "binary")(F.coalesce(F.col(text), F.lit(""))))


def with_audio(df: DataFrame, media: str = "media", out: str = "audio") -> DataFrame:
    """``df`` with what ``parse`` reads from a binary column."""
    return df.withColumn(out, F.arrow_udf(read_media, PARSED)(F.col(media)))


def op2_mpeg_audio(docs: DataFrame) -> DataFrame:
    """Digest of each document's stream, computed from the bytes read back."""
    whole = with_audio(with_media(docs.select("doc_id", "text")))
    a = F.col("audio")
    feature = F.format_string(
        "mpeg%d/layer%d sr=%d ch=%d frames=%d samples=%d us=%d kbps=%d-%d table=%s:%d crc=%d/%d resync=%d ok=%s seek=%s",
        a.version, a.layer, a.sample_rate, a.channels, a.frames, a.samples, a.duration_us, a.kbps_min, a.kbps_max, a.table, a.table_frames,
        a.crc_ok, a.crc_bad, a.resyncs, a.payload_ok.cast("string"), F.sha2(F.array_join(a.offsets.cast("array<string>"), ",").cast("binary"), 256),
    )
    return whole.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.octet_length(a.payload).cast("long").alias("payload_bytes"),
        F.sha2(a.payload, 256).alias("payload_sha256"),
        F.crc32(F.substring(a.payload, -BLOCK, BLOCK)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        feature.alias("feature"),
        a.frames.alias("n_frames"),
        a.duration_us.alias("duration_us"),
        a.offsets.alias("seek_offsets"),
        a.payload_ok.alias("payload_ok"),
    )
