"""Media columns as MPEG transport streams (operator 10).

A payload of 8-bit samples is stored as one program: a program association table, a program
map table, and one elementary stream of private data, cut into access units of `UNIT`
bytes. Every unit is one packetised elementary packet with a 90 kHz timestamp; every
`KEY_UNITS`-th carries the random-access mark and a clock reference, and the tables come again
before it, so that reading can begin there. Packets are 188 bytes with continuity counters
per stream; the last packet of a unit is stuffed in its adaptation field.

Reading takes nothing for granted: it finds the stream through the tables (with their
checksums), checks sync bytes and continuity counters, reassembles the elementary packets and takes
timestamps and random-access points from them.

Defined results: a null text counts as empty; an empty payload is padded to one block like
any other; equal texts give equal streams; a stream that is damaged raises `DamagedStream`
with the place.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from meetlake.session import staged

BLOCK, FILL = 576, 255
UNIT = 8 * BLOCK
KEY_UNITS = 8
#: 90 kHz ticks of one access unit at 8,000 samples a second.
UNIT_TICKS = UNIT * 90_000 // 8_000

PACKET, SYNC = 188, 0x47
PAT_PID, PMT_PID, STREAM_PID = 0x0000, 0x0100, 0x0101
PROGRAM, PRIVATE_DATA, PRIVATE_STREAM = 1, 0x06, 0xBD
_COLUMNS = np.arange(PACKET)


class DamagedStream(ValueError):
    """A transport stream that breaks its format."""


def _crc_table() -> list[int]:
    table = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = (c << 1) ^ (0x04C11DB7 if c & 0x80000000 else 0)
        table.append(c & 0xFFFFFFFF)
    return table


_CRC = _crc_table()


def section_crc(data: bytes) -> int:
    """CRC-32 of program tables: most significant bit first, no final inversion."""
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ _CRC[(c >> 24) ^ b]
    return c


def _section(table: int, number: int, body: bytes) -> bytes:
    head = bytes([table]) + (0xB000 | (len(body) + 9)).to_bytes(2, "big")
    data = head + number.to_bytes(2, "big") + b"\xc1\x00\x00" + body
    return data + section_crc(data).to_bytes(4, "big")


PAT = _section(0x00, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
PMT = _section(
    0x02,
    PROGRAM,
    (0xE000 | STREAM_PID).to_bytes(2, "big") + b"\xf0\x00"
    + bytes([PRIVATE_DATA]) + (0xE000 | STREAM_PID).to_bytes(2, "big") + b"\xf0\x00",
)


def _stamp(ticks: int) -> bytes:
    """A timestamp of 33 bits with its marker bits."""
    t = ticks % 2**33
    high = 0x21 | ((t >> 30) & 7) << 1
    return (
        bytes([high])
        + (((t >> 15) & 0x7FFF) << 1 | 1).to_bytes(2, "big")
        + ((t & 0x7FFF) << 1 | 1).to_bytes(2, "big")
    )


def _stamped(raw: bytes) -> int:
    a, b, c = raw[0], int.from_bytes(raw[1:3], "big"), int.from_bytes(raw[3:5], "big")
    return ((a >> 1) & 7) << 30 | (b >> 1) << 15 | c >> 1


def _table_packet(pid: int, counter: int, section: bytes) -> bytes:
    head = bytes([SYNC, 0x40 | pid >> 8, pid & 0xFF, 0x10 | counter % 16])
    return (head + b"\x00" + section).ljust(PACKET, b"\xff")


def _unit_packets(unit: bytes, number: int, counter: int) -> np.ndarray:
    """Packets of one access unit, the first of them with `counter`."""
    ticks = number * UNIT_TICKS
    optional = b"\x84\x80\x05" + _stamp(ticks)
    pes = b"\x00\x00\x01" + bytes([PRIVATE_STREAM])
    pes += (len(optional) + len(unit)).to_bytes(2, "big") + optional + unit
    first = b""
    if number % KEY_UNITS == 0:  # random access, and a clock reference at the unit's time
        clock = (ticks % 2**33) << 15 | 0x7E00
        first = b"\x07\x50" + clock.to_bytes(6, "big")
    room = PACKET - 4 - len(first)
    n = 1 + max(0, -(-(len(pes) - room) // (PACKET - 4)))
    out = np.full((n, PACKET), 0xFF, dtype=np.uint8)
    out[:, 0], out[:, 1], out[:, 2] = SYNC, STREAM_PID >> 8, STREAM_PID & 0xFF
    out[0, 1] |= 0x40
    out[:, 3] = 0x10 | (counter + np.arange(n)) % 16
    data, at = np.frombuffer(pes, dtype=np.uint8), 0
    if first:
        out[0, 3] |= 0x20
        out[0, 4 : 4 + len(first)] = list(first)
    if n > 1:
        out[0, 4 + len(first) :] = data[:room]
        at = room
        whole = (n - 2) * (PACKET - 4)
        out[1 : n - 1, 4:] = data[at : at + whole].reshape(n - 2, PACKET - 4)
        at += whole
    # the rest ends at the packet's end; what is free before it goes to the adaptation field
    rest, begin = data[at:], 4 + (len(first) if n == 1 else 0)
    spare = PACKET - begin - len(rest)
    if spare:
        last = out[n - 1]
        last[3] |= 0x20
        if begin > 4:
            last[4] += spare
        else:
            last[4] = spare - 1
            if spare > 1:
                last[5] = 0
    out[n - 1, PACKET - len(rest) :] = rest
    return out


def padded(data: bytes) -> bytes:
    """The payload: filled up to a positive multiple of the block."""
    return data + bytes([FILL]) * (-len(data) % BLOCK or (0 if data else BLOCK))


def mux(payload: bytes) -> bytes:
    """A payload as a transport stream."""
    out, tables, counter = [], 0, 0
    for number, at in enumerate(range(0, len(payload), UNIT)):
        if number % KEY_UNITS == 0:
            out += [_table_packet(PAT_PID, tables, PAT), _table_packet(PMT_PID, tables, PMT)]
            tables += 1
        packets = _unit_packets(payload[at : at + UNIT], number, counter)
        counter += len(packets)
        out.append(packets.tobytes())
    return b"".join(out)


@dataclass(frozen=True)
class Elementary:
    """What reading a stream gives: samples, and per unit timestamp, size and access mark."""

    payload: bytes
    packets: int
    stamps: list[int]
    sizes: list[int]
    entry_points: list[int]

    def feature(self) -> str:
        level = np.frombuffer(self.payload, dtype=np.uint8)
        entries = ",".join(str(self.stamps[i]) for i in self.entry_points)
        return (
            f"units={len(self.sizes)};packets={self.packets};pts={self.stamps[0]}-{self.stamps[-1]}"
            f";random_access={entries};mean={int(level.sum()) // len(level)}"
            f";peak={int(level.max())}"
        )


def _table_of(packet: np.ndarray, table: int) -> bytes:
    raw = packet.tobytes()
    at = 5 + raw[4]
    size = int.from_bytes(raw[at + 1 : at + 3], "big") & 0x0FFF
    section = raw[at : at + 3 + size]
    if section[0] != table or section_crc(section) != 0:
        raise DamagedStream(f"program table {table} is damaged")
    return section


def demux(stream: bytes) -> Elementary:
    """Read a transport stream back."""
    if not stream or len(stream) % PACKET:
        raise DamagedStream("not a whole number of packets")
    rows = np.frombuffer(stream, dtype=np.uint8).reshape(-1, PACKET)
    if (rows[:, 0] != SYNC).any():
        raise DamagedStream(f"no sync byte in packet {int((rows[:, 0] != SYNC).argmax())}")
    pids = (rows[:, 1].astype(np.int64) & 0x1F) << 8 | rows[:, 2]
    for pid in np.unique(pids):
        counter = rows[pids == pid, 3].astype(np.int64) & 15
        if ((np.diff(counter) - 1) % 16).any():
            raise DamagedStream(f"packets of stream {pid} are missing")
    tables = rows[pids == PAT_PID]
    if not len(tables):
        raise DamagedStream("no program association table")
    pat = _table_of(tables[0], 0x00)
    pmt_pid = int.from_bytes(pat[10:12], "big") & 0x1FFF
    maps = rows[pids == pmt_pid]
    if not len(maps):
        raise DamagedStream("no program map table")
    pmt = _table_of(maps[0], 0x02)
    skip = 12 + (int.from_bytes(pmt[10:12], "big") & 0x0FFF)
    own = rows[pids == (int.from_bytes(pmt[skip + 1 : skip + 3], "big") & 0x1FFF)]
    has_field = (own[:, 3] & 0x20) > 0
    begin = np.where(has_field, 5 + own[:, 4].astype(np.int64), 4)
    body = own[_COLUMNS >= begin[:, None]].tobytes()
    starts = np.flatnonzero(own[:, 1] & 0x40)
    at = np.concatenate([[0], np.cumsum(PACKET - begin)])
    marked = has_field & (own[:, 4] > 0) & ((own[:, 5] & 0x40) > 0)
    parts, stamps, sizes = [], [], []
    for a, b in zip(at[starts].tolist(), [*at[starts[1:]].tolist(), len(body)]):
        length = int.from_bytes(body[a + 4 : a + 6], "big")
        if body[a : a + 3] != b"\x00\x00\x01" or a + 6 + length != b:
            raise DamagedStream("an elementary packet is damaged")
        stamps.append(_stamped(body[a + 9 : a + 14]))
        parts.append(body[a + 9 + body[a + 8] : b])
        sizes.append(len(parts[-1]))
    entries = np.flatnonzero(marked[starts]).tolist()
    return Elementary(b"".join(parts), len(rows), stamps, sizes, entries)


@F.pandas_udf(BinaryType())
def stream_of(texts: pd.Series) -> pd.Series:
    """Texts (UTF-8) as transport streams."""
    return texts.map(lambda t: mux(padded((t or "").encode("utf-8", "replace"))))


_READ = StructType(
    [
        StructField("payload_bytes", LongType()),
        StructField("payload_sha256", StringType()),
        StructField("tail_crc32", LongType()),
        StructField("feature", StringType()),
    ]
)


@F.pandas_udf(_READ)
def read_back(streams: pd.Series) -> pd.DataFrame:
    """Size, digest, checksum of the last 32 samples and features of the samples read back."""

    def row(stream):
        e = demux(bytes(stream))
        digest = hashlib.sha256(e.payload).hexdigest()
        return len(e.payload), digest, zlib.crc32(e.payload[-32:]), e.feature()

    return pd.DataFrame([row(s) for s in streams], columns=_READ.fieldNames())


def stored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts in a written table with a media column: doc_id, n_bytes (of the text), media."""
    full = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.octet_length(full).cast("bigint").alias("n_bytes"),
        stream_of(full).alias("media"),
    )
    return staged(rows, "media")


def measured(media: DataFrame) -> DataFrame:
    """Per row of a media table what its stored bytes hold."""
    return media.select(
        "doc_id",
        "n_bytes",
        read_back("media").alias("read"),
        F.octet_length("media").cast("bigint").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
    ).select("doc_id", "n_bytes", "read.*", "media_bytes", "media_sha256")
