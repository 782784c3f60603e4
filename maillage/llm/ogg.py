"""Media columns: Ogg streams. Pages with checksums, lacing, logical streams, granule positions.

``store`` keeps bytes as unsigned 8-bit samples in an Ogg stream of two logical streams, one for the
samples at even and one for those at odd places, each a PCM header packet and data packets, with the
pages of both interleaved. ``read_pages`` and ``demultiplex`` read any Ogg stream: they find pages by
their capture pattern, verify page checksums, put packets together from lacing values across pages,
separate logical streams by serial number, and turn granule positions into seconds.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = 192  # payloads are padded with spaces to a positive multiple of this
RATE = 8000  # samples a second in each logical stream
SERIALS = (1, 2)
PACKET_SAMPLES = 4080  # 16 lacing values of 255 and one of 0
PAGE_SEGMENTS = 255

CAPTURE = b"OggS"
# Version, type, granule position, serial, sequence, checksum, segments: the 27 fixed bytes of a page.
PAGE_HEADER = struct.Struct("<4sBBqIIIB")
CONTINUED, FIRST, LAST = 1, 2, 4
# Identification packet of the PCM mapping: magic, major, minor, format (1: unsigned 8 bit), rate,
# significant bits, channels, frames a packet, further headers.
PCM_HEADER = struct.Struct(">8sHHIIBBHI")
PCM_MAGIC = b"PCM     "

_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def page_crc(page: bytes) -> int:
    """Checksum of a page whose checksum field is zero: CRC-32 with the top bit first, from 0, not inverted.

    zlib's CRC has the same polynomial with the lowest bit first, so it is run on bytes with their bits
    reversed, its inversions are undone, and the result is reversed.
    """
    crc = (zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF).to_bytes(4, "little")
    return int.from_bytes(crc.translate(_REVERSED), "big")


def _page(kind: int, granule: int, serial: int, sequence: int, lacing: bytes, body: bytes) -> bytes:
    head = PAGE_HEADER.pack(CAPTURE, 0, kind, granule, serial, sequence, 0, len(lacing)) + lacing
    crc = page_crc(head + body)
    return head[:22] + crc.to_bytes(4, "little") + head[26:] + body


def lacing_of(length: int) -> bytes:
    return b"\xff" * (length // 255) + bytes([length % 255])


def paginate(packets: list[tuple[bytes, int]], serial: int) -> list[bytes]:
    """Pages of one logical stream. A packet comes with the granule position at its end; the first has a page of its own."""
    pages: list[bytes] = []
    lacing, body, granule, continued = b"", [], -1, False

    def flush(last: bool, goes_on: bool) -> None:
        nonlocal lacing, body, granule, continued
        kind = CONTINUED * continued | FIRST * (not pages) | LAST * last
        pages.append(_page(kind, granule, serial, len(pages), lacing, b"".join(body)))
        lacing, body, granule, continued = b"", [], -1, goes_on

    for k, (packet, at) in enumerate(packets):
        values, done = lacing_of(len(packet)), 0
        while values:
            room = PAGE_SEGMENTS - len(lacing)
            part, values = values[:room], values[room:]
            size = sum(part)
            lacing += part
            body.append(packet[done : done + size])
            done += size
            if values:
                flush(False, True)
        granule = at
        if k == len(packets) - 1:
            flush(True, False)
        elif k == 0 or len(lacing) == PAGE_SEGMENTS:
            flush(False, False)
    return pages


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes padded with spaces, and how many bytes the text has."""
    raw = (text or "").encode()
    return raw + b" " * (-len(raw) % UNIT or UNIT * (not raw)), len(raw)


def store(payload: bytes) -> bytes:
    """The payload as an Ogg stream of two interleaved logical PCM streams."""
    streams = []
    for k, serial in enumerate(SERIALS):
        samples = payload[k :: len(SERIALS)]
        head = PCM_HEADER.pack(PCM_MAGIC, 0, 0, 1, RATE, 8, 1, PACKET_SAMPLES, 0)
        packets = [(head, 0)]
        packets += [(samples[i : i + PACKET_SAMPLES], min(len(samples), i + PACKET_SAMPLES)) for i in range(0, len(samples), PACKET_SAMPLES)]
        streams.append(paginate(packets, serial))
    out = [page for pages in zip(*streams, strict=True) for page in pages]  # equal lengths: a payload is even
    return b"".join(out)


@dataclass
class Stream:
    """What was read of one logical stream."""

    serial: int
    packets: list[bytes] = field(default_factory=list)
    granules: list[int] = field(default_factory=list)  # of each page on which a packet ends
    pages: int = 0
    gaps: int = 0  # missing page numbers
    lost: int = 0  # packets of which a part is missing
    ended: bool = False
    rate: int = 0
    _open: list[bytes] | None = None
    _next: int | None = None

    def seconds(self) -> float | None:
        """Time at the end, from the last granule position."""
        return self.granules[-1] / self.rate if self.granules and self.rate else None


def read_pages(data: bytes):
    """Pages of a stream as (kind, granule, serial, sequence, lacing, body), or None for bytes that are no sound page."""
    at = 0
    while (found := data.find(CAPTURE, at)) >= 0:
        if found > at:
            yield None  # bytes between pages
        head_end = found + PAGE_HEADER.size
        if head_end > len(data):
            yield None
            return
        _, version, kind, granule, serial, sequence, crc, n = PAGE_HEADER.unpack_from(data, found)
        lacing = data[head_end : head_end + n]
        end = head_end + n + sum(lacing)
        page = data[found:end]
        if version or len(lacing) < n or end > len(data) or page_crc(page[:22] + b"\0\0\0\0" + page[26:]) != crc:
            yield None
            at = found + 1  # look for the next capture pattern
            continue
        yield kind, granule, serial, sequence, lacing, data[head_end + n : end]
        at = end
    if at < len(data):
        yield None


def demultiplex(data: bytes) -> tuple[dict[int, Stream], int]:
    """Logical streams by serial number, and how many stretches were no sound page.

    A packet that misses a page is dropped and counted as lost, as is one that never ends.
    """
    streams: dict[int, Stream] = {}
    bad = 0
    for page in read_pages(data):
        if page is None:
            bad += 1
            continue
        kind, granule, serial, sequence, lacing, body = page
        s = streams.setdefault(serial, Stream(serial))
        if s._next is not None and sequence != s._next:
            s.gaps += 1
            s.lost += s._open is not None
            s._open = None
        s._next = (sequence + 1) & 0xFFFFFFFF
        s.pages += 1
        s.ended |= bool(kind & LAST)
        skip = bool(kind & CONTINUED) and s._open is None  # the packet's beginning is missing
        s.lost += skip
        if not kind & CONTINUED and s._open is not None:
            s.lost += 1
            s._open = None
        at = size = 0
        for value in lacing:
            size += value
            if value == 255:
                continue
            if skip:
                skip = False
            else:
                s.packets.append(b"".join([*(s._open or []), body[at : at + size]]))
            s._open = None
            at, size = at + size, 0
        if (size or lacing[-1:] == b"\xff") and not skip:
            s._open = [*(s._open or []), body[at : at + size]]
        if granule >= 0:
            s.granules.append(granule)
    for s in streams.values():
        s.lost += s._open is not None
        if s.packets and s.packets[0].startswith(PCM_MAGIC) and len(s.packets[0]) >= PCM_HEADER.size:
            s.rate = PCM_HEADER.unpack_from(s.packets[0])[4]
    return streams, bad


def restore(data: bytes) -> tuple[bytes, dict]:
    """Payload of a stored stream and what was seen while reading it."""
    streams, bad = demultiplex(data)
    lanes = [b"".join(streams[k].packets[1:]) if k in streams else b"" for k in SERIALS]
    payload = bytearray(sum(map(len, lanes)))
    if len(lanes[0]) == len(lanes[1]):
        payload[0::2], payload[1::2] = lanes
    else:
        payload[:] = b"".join(lanes)  # damaged: nothing to interleave
    seen = list(streams.values())
    return bytes(payload), {
        "streams": len(seen), "pages": sum(s.pages for s in seen), "packets": sum(len(s.packets) for s in seen), "bad_pages": bad,
        "gaps": sum(s.gaps for s in seen), "lost_packets": sum(s.lost for s in seen), "ended": bool(seen) and all(s.ended for s in seen),
        "seconds": max((s.seconds() or 0.0 for s in seen), default=0.0),
    }


READ = pa.struct([
    ("payload", pa.binary()), ("streams", pa.int32()), ("pages", pa.int32()), ("packets", pa.int32()), ("bad_pages", pa.int32()),
    ("gaps", pa.int32()), ("lost_packets", pa.int32()), ("ended", pa.bool_()), ("seconds", pa.float64()),
])
READ_TYPE = (
    "struct<payload:binary,streams:int,pages:int,packets:int,bad_pages:int,gaps:int,lost_packets:int,ended:boolean,seconds:double>"
)


def _stored(text: pa.Array) -> pa.Array:
    return pa.array((store(payload_of(t)[0]) for t in text.to_pylist()), pa.binary())


def _restored(media: pa.Array) -> pa.Array:
    rows = []
    for data in media.to_pylist():
        payload, seen = restore(data or b"")
        rows.append({"payload": payload} | seen)
    return pa.array(rows, READ)


def store_text(text: Column) -> Column:
    """Ogg stream of a text's padded UTF-8 bytes; a null text is stored as an empty one."""
    return F.arrow_udf(_stored, "binary")(text)


def read_media(media: Column) -> Column:
    """Struct of the payload and what reading found; null or foreign bytes give an empty payload and no streams."""
    return F.arrow_udf(_restored, READ_TYPE)(media)




def media_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text stored as Ogg, read back, and described.

    One row per input row, repeated rows included; a null text is empty (192 spaces); other columns are
    not read, so their names cannot clash. An empty table gives an empty result.
    """
    media = docs.select(
        F.col(id_col), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"), store_text(F.col(text_col)).alias("media")
    )
    read = media.select(
        id_col, "n_bytes", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"),
        read_media(F.col("media")).alias("r"),
    )
    feature = F.concat_ws(
        ";", *(F.concat(F.lit(f"{n}="), F.col(f"r.{n}").cast("string")) for n in ("streams", "pages", "packets", "bad_pages", "gaps", "lost_packets", "ended")),
        F.concat(F.lit("ms="), F.round(F.col("r.seconds") * 1000).cast("long").cast("string")),
    )
    return read.select(
        id_col, "n_bytes", F.octet_length("r.payload").cast("long").alias("payload_bytes"), F.sha2("r.payload", 256).alias("payload_sha256"),
        F.crc32(F.substring(F.col("r.payload"), -16, 16)).alias("tail_crc32"), "media_bytes", "media_sha256", feature.alias("feature"),
        F.col("r.seconds").alias("seconds"),
    )
