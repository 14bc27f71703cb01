"""ZIP packages of stored members: a writer that always adds ZIP64 records, and a reader by ranges.

The reader takes ``read(offset, length)`` and the size of the file. It needs the end of the
file, the central directory and one local header for each member it looks into; member
contents are never copied out as a whole.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass

# Signatures, record layouts and marks of the ZIP format; fixed values.
LOCAL, CENTRAL, END, END64, LOCATOR64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
LOCAL_LAYOUT, CENTRAL_LAYOUT = "<IHHHHHIIIHH", "<IHHHHHHIIIHHHHHII"
END_LAYOUT, END64_LAYOUT, LOCATOR64_LAYOUT = "<IHHHHIIH", "<IQHHIIQQQQ", "<IIQI"
ZIP64_EXTRA, VERSION64, UTF8_NAME, STREAMED = 1, 45, 1 << 11, 1 << 3
DATE_1980 = 33
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    crc: int
    size: int
    header: int


class Writer:
    """Writes stored members to an append-only stream; sizes follow their data."""

    def __init__(self, stream):
        self.stream, self.at, self.members = stream, 0, []

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.header, self.crc = name, self.at, 0
        raw = name.encode()
        extra = struct.pack("<HHQQ", ZIP64_EXTRA, 16, 0, 0)
        self._put(struct.pack(LOCAL_LAYOUT, LOCAL, VERSION64, UTF8_NAME | STREAMED, 0, 0, DATE_1980, 0, FULL32, FULL32, len(raw), len(extra)) + raw + extra)
        self.data = self.at

    def write(self, data: bytes) -> int:
        """Append to the open member; the offset of ``data`` in it."""
        offset = self.at - self.data
        self.crc = zlib.crc32(data, self.crc)
        self._put(data)
        return offset

    def end(self) -> None:
        size = self.at - self.data
        self._put(struct.pack("<IIQQ", 0x08074B50, self.crc, size, size))
        self.members.append(Member(self.name, 0, self.crc, size, self.header))

    def close(self) -> None:
        start = self.at
        for m in self.members:
            raw = m.name.encode()
            extra = struct.pack("<HHQQQ", ZIP64_EXTRA, 24, m.size, m.size, m.header)
            self._put(
                struct.pack(CENTRAL_LAYOUT, CENTRAL, VERSION64, VERSION64, UTF8_NAME | STREAMED, 0, 0, DATE_1980, m.crc,
                            FULL32, FULL32, len(raw), len(extra), 0, 0, 0, 0, FULL32) + raw + extra
            )
        size, count, end64 = self.at - start, len(self.members), self.at
        self._put(struct.pack(END64_LAYOUT, END64, 44, VERSION64, VERSION64, 0, 0, count, count, size, start))
        self._put(struct.pack(LOCATOR64_LAYOUT, LOCATOR64, 0, end64, 1))
        self._put(struct.pack(END_LAYOUT, END, 0, 0, FULL16, FULL16, FULL32, FULL32, 0))


Read = Callable[[int, int], bytes]


def directory(read: Read, size: int) -> list[Member]:
    """Members from the central directory, with or without ZIP64 records."""
    tail_at = max(0, size - (struct.calcsize(END_LAYOUT) + FULL16))
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(struct.pack("<I", END))
    if at < 0:
        raise ValueError("no end of a central directory")
    _, _, _, _, count, length, start, _ = struct.unpack_from(END_LAYOUT, tail, at)
    locator_at = tail_at + at - struct.calcsize(LOCATOR64_LAYOUT)
    if locator_at >= 0:
        signature, _, end64, _ = struct.unpack(LOCATOR64_LAYOUT, read(locator_at, struct.calcsize(LOCATOR64_LAYOUT)))
        if signature == LOCATOR64:
            record = struct.unpack(END64_LAYOUT, read(end64, struct.calcsize(END64_LAYOUT)))
            if record[0] != END64:
                raise ValueError("the ZIP64 locator leads nowhere")
            count, length, start = record[7:]
    raw, at, members = read(start, length), 0, []
    for _ in range(count):
        x = struct.unpack_from(CENTRAL_LAYOUT, raw, at)
        if x[0] != CENTRAL:
            raise ValueError("a broken central directory")
        names, extras, comments = x[10:13]
        at += struct.calcsize(CENTRAL_LAYOUT)
        name, extra = raw[at : at + names], raw[at + names : at + names + extras]
        at += names + extras + comments
        packed, full, header = _wide(extra, x[8], x[9], x[16])
        if x[4] == 0 and packed != full:
            raise ValueError("a stored member of two sizes")
        members.append(Member(name.decode("utf-8" if x[3] & UTF8_NAME else "cp437"), x[4], x[7], packed, header))
    return members


def _wide(extra: bytes, packed: int, full: int, header: int) -> tuple[int, int, int]:
    """Sizes and offset; those marked as full are in the ZIP64 extra field, in this order."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_EXTRA:
            values = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            full = next(values) if full == FULL32 else full
            packed = next(values) if packed == FULL32 else packed
            header = next(values) if header == FULL32 else header
        at += 4 + length
    return packed, full, header


def data_offset(read: Read, member: Member) -> int:
    """Where the bytes of a stored member begin in the file."""
    if member.method:
        raise ValueError(f"{member.name} is compressed; ranges need stored members")
    fixed = struct.calcsize(LOCAL_LAYOUT)
    x = struct.unpack(LOCAL_LAYOUT, read(member.header, fixed))
    if x[0] != LOCAL:
        raise ValueError(f"no local header of {member.name}")
    return member.header + fixed + x[9] + x[10]
