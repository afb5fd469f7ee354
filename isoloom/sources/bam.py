"""BAM files as a Spark data source whose partitions are byte ranges.

A BAM file is a row of gzip members of at most 64 KiB (BGZF) that hold a header and then
records; records go over members' ends. A partition takes the records whose first byte lies
in a member that begins in its range. It looks for the first such member by its magic and
the one after it, and for the first record there by what fields of records can hold, for
several records in a row, as no index tells. Nothing is read on the driver but file sizes.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

ALIGNMENTS = "sample string, read_id string, flag int, Chr string, pos bigint, cigar string, seq string, xs string, ts string, nm bigint, pt bigint"
_TYPES = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
_SCHEMA = pa.schema([pa.field(f.split()[0], t) for f, t in zip(ALIGNMENTS.split(", "), _TYPES)])
_MAGIC = b"\x1f\x8b\x08\x04"
_MOST = 1 << 16
#: Fixed values of the format: CIGAR operations, bases of four bits, sizes of tag values.
_OPS, _BASES, _SIZES = "MIDNSHP=X", "=ACMGRSVTWYHKDBN", {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
_INTS = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I"}
_TO_BASES = str.maketrans("0123456789abcdef", _BASES)
#: Operations that take bases of the read.
_READ = {0, 1, 4, 7, 8}
_FIXED = struct.Struct("<iiBBHHHiiii")
#: So many records in a row must look like records.
_SURE = 4


class Blocks:
    """Members of an open file."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.size = file, file.size()

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def length(self, at: int) -> int | None:
        """Bytes of the member at an offset, or None if there is none."""
        head = self._read(at, 12)
        if len(head) < 12 or head[:4] != _MAGIC:
            return None
        extra = self._read(at + 12, struct.unpack("<H", head[10:])[0])
        i = 0
        while i + 4 <= len(extra):
            n = struct.unpack("<H", extra[i + 2 : i + 4])[0]
            if extra[i : i + 2] == b"BC" and n == 2:
                return struct.unpack("<H", extra[i + 4 : i + 6])[0] + 1
            i += 4 + n
        return None

    def data(self, at: int) -> tuple[bytes, int]:
        """What a member holds, and where the next begins."""
        n = self.length(at)
        if n is None:
            raise ValueError(f"no BGZF member at byte {at}")
        return zlib.decompress(self._read(at, n), 31), at + n

    def first(self, at: int) -> int | None:
        """The first member that begins at an offset or behind it."""
        around = self._read(at, 2 * _MOST + len(_MAGIC))
        i = around.find(_MAGIC)
        while i >= 0:
            n = self.length(at + i)
            if n and (at + i + n == self.size or self.length(at + i + n)):
                return at + i
            i = around.find(_MAGIC, i + 1)
        return None


class Stream:
    """Bytes of the members from one on, and which member each belongs to."""

    def __init__(self, blocks: Blocks, at: int):
        self.blocks, self.at, self.held, self.dropped, self.starts, self.ends = blocks, at, bytearray(), 0, [], []

    def more(self) -> bool:
        """Adds a member; False at the end of the file."""
        if self.at >= self.blocks.size:
            return False
        start = self.at
        data, self.at = self.blocks.data(start)
        self.held += data
        self.starts.append(start)
        self.ends.append((self.ends[-1] if self.ends else 0) + len(data))
        return True

    def have(self, end: int) -> bool:
        while self.dropped + len(self.held) < end:
            if not self.more():
                return False
        return True

    def drop(self, until: int) -> None:
        """Forgets the bytes before a place."""
        if until - self.dropped > 1 << 20:
            del self.held[: until - self.dropped]
            self.dropped = until
            while self.ends and self.ends[0] <= until and len(self.ends) > 1:
                self.ends.pop(0)
                self.starts.pop(0)

    def get(self, a: int, b: int) -> bytes:
        return bytes(self.held[a - self.dropped : b - self.dropped])

    def member(self, place: int) -> int:
        """Where the member of a byte that is held begins."""
        return next(s for s, e in zip(self.starts, self.ends) if place < e)


def header(blocks: Blocks) -> tuple[list[str], list[int], int, int]:
    """Names and lengths of contigs; the member of the first record and its place there."""
    s = Stream(blocks, 0)
    if not s.have(12) or s.get(0, 4) != b"BAM\1":
        raise ValueError("not a BAM file")
    at = 8 + struct.unpack("<i", s.get(4, 8))[0]
    s.have(at + 4)
    n = struct.unpack("<i", s.get(at, at + 4))[0]
    at, names, lengths = at + 4, [], []
    for _ in range(n):
        s.have(at + 4)
        k = struct.unpack("<i", s.get(at, at + 4))[0]
        s.have(at + 8 + k)
        names.append(s.get(at + 4, at + 3 + k).decode())
        lengths.append(struct.unpack("<i", s.get(at + 4 + k, at + 8 + k))[0])
        at += 8 + k
    if not s.have(at + 1):
        return names, lengths, blocks.size, 0
    start = s.member(at)
    return names, lengths, start, at - next((e for x, e in zip(s.starts[1:], s.ends) if x == start), 0)


def _looks(s: Stream, at: int, lengths: list[int]) -> int | None:
    """The end of the record at a place, if there can be one."""
    if not s.have(at + 36):
        return None
    size, ref, pos, name, _, _, ops, flag, bases, next_ref, next_pos = (*struct.unpack("<i", s.get(at, at + 4)), *_FIXED.unpack(s.get(at + 4, at + 36))[:10])
    if not (32 <= size < 1 << 28 and -1 <= ref < len(lengths) and -1 <= next_ref < len(lengths) and name >= 1 and bases >= 0 and flag < 1 << 13):
        return None
    if pos < -1 or next_pos < -1 or (ref >= 0 and pos > lengths[ref]) or 32 + name + 4 * ops + (bases + 1) // 2 + bases > size or not s.have(at + 4 + size):
        return None
    text = s.get(at + 36, at + 36 + name)
    if text[-1] != 0 or not all(33 <= c <= 126 for c in text[:-1]):
        return None
    cigar = struct.unpack(f"<{ops}I", s.get(at + 36 + name, at + 36 + name + 4 * ops))
    if any(c & 15 >= len(_OPS) for c in cigar) or (ops and bases and sum(c >> 4 for c in cigar if c & 15 in _READ) != bases):
        return None
    return at + 4 + size


def _first_record(s: Stream, lengths: list[int]) -> int | None:
    """The first place from which records follow one another, to the end of the file if it is near."""
    at = 0
    while s.have(at + 1):
        end, sure = _looks(s, at, lengths), 1
        while end is not None and sure < _SURE and s.have(end + 1):
            end, sure = _looks(s, end, lengths), sure + 1
        if end is not None:
            return at
        at += 1
    return None


def _tags(raw: bytes) -> dict[bytes, object]:
    out, i = {}, 0
    while i + 3 <= len(raw):
        tag, kind, i = raw[i : i + 2], chr(raw[i + 2]), i + 3
        if kind in "ZH":
            end = raw.index(0, i)
            out[tag], i = raw[i:end].decode("utf-8", "replace"), end + 1
        elif kind == "B":
            sub, n = chr(raw[i]), struct.unpack("<I", raw[i + 1 : i + 5])[0]
            end = i + 5 + n * _SIZES[sub]
            out[tag], i = raw[i + 5 : end], end
        else:
            n = _SIZES[kind]
            value = raw[i : i + n]
            out[tag] = value.decode("latin-1") if kind == "A" else struct.unpack(_INTS.get(kind, "<f"), value)[0]
            i += n
    return out


def decode(raw: bytes, names: list[str]) -> tuple:
    """(read_id, flag, Chr, pos, cigar, seq, xs, ts, nm, pt) of a record without its size."""
    ref, pos, name, _, _, ops, flag, bases, *_ = _FIXED.unpack(raw[:32])
    at = 32 + name
    cigar = struct.unpack(f"<{ops}I", raw[at : at + 4 * ops])
    at += 4 * ops
    seq = raw[at : at + (bases + 1) // 2].hex().translate(_TO_BASES)[:bases] or "*"
    tags = _tags(raw[at + (bases + 1) // 2 + bases :])
    if b"CG" in tags and ops == 2 and cigar[0] == bases << 4 | 4 and cigar[1] & 15 == 3:  # more operations than the field holds
        cigar = struct.unpack(f"<{len(tags[b'CG']) // 4}I", tags[b"CG"])
    text = "".join(f"{c >> 4}{_OPS[c & 15]}" for c in cigar) or "*"
    whole = lambda t: tags[t] if isinstance(tags.get(t), int) else None
    letter = lambda t: tags[t] if isinstance(tags.get(t), str) else None
    return raw[32 : at].split(b"\0", 1)[0].decode(), flag, names[ref] if ref >= 0 else "*", pos + 1, text, seq, letter(b"XS"), letter(b"ts"), whole(b"NM"), whole(b"pt")


def records(file: pa.NativeFile, lo: int, hi: int) -> Iterator[tuple]:
    """Records whose first byte lies in a member that begins at lo or later, and before hi."""
    blocks = Blocks(file)
    names, lengths, start, inside = header(blocks)
    if lo <= start:
        if not start < hi or start >= blocks.size:
            return
        s, at = Stream(blocks, start), inside
    else:
        member = blocks.first(lo)
        if member is None or member >= hi:
            return
        s = Stream(blocks, member)
        at = _first_record(s, lengths)
        if at is None:
            return
    while s.have(at + 1) and s.member(at) < hi:
        if not s.have(at + 4) or not s.have(at + 4 + (n := struct.unpack("<i", s.get(at, at + 4))[0])):
            raise ValueError("the file ends within a record")
        yield decode(s.get(at + 4, at + 4 + n), names)
        at += 4 + n
        s.drop(at)


@dataclass
class Range(InputPartition):
    path: str
    lo: int
    hi: int

    def __init__(self, path: str, lo: int, hi: int):
        super().__init__(None)
        self.path, self.lo, self.hi = path, lo, hi


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.paths = options["path"].split(",")
        self.step = int(options.get("splitbytes", 64 << 20))

    def partitions(self):
        out = []
        for given in self.paths:
            system, path = _system(given)
            info = system.get_file_info(path)
            found = [info] if info.is_file else [f for f in system.get_file_info(fs.FileSelector(path)) if f.is_file and f.path.endswith(".bam")]
            if not found:
                raise FileNotFoundError(given)
            root = given[: len(given) - len(path)] if given.endswith(path) else ""
            out += [Range(root + f.path, lo, min(lo + self.step, f.size)) for f in sorted(found, key=lambda f: f.path) for lo in range(0, f.size, self.step)]
        return out

    def read(self, partition):
        system, path = _system(partition.path)
        sample = os.path.basename(path).rsplit(".", 1)[0]
        rows: list[tuple] = []
        with system.open_input_file(path) as file:
            for row in records(file, partition.lo, partition.hi):
                rows.append((sample, *row))
                if len(rows) == 2048:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], schema=_SCHEMA)


def _system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), os.path.abspath(path))


class BamSource(DataSource):
    """Format ``bam``: options path (files or folders, by commas; any address that Arrow's
    file systems know) and splitbytes."""

    @classmethod
    def name(cls):
        return "bam"

    def schema(self):
        return ALIGNMENTS

    def reader(self, schema):
        return _Reader(self.options)


def read_bam(spark: SparkSession, path: str, split_bytes: int = 64 << 20) -> DataFrame:
    """Mapped alignments with a sequence of BAM files, as ``read_sam`` gives them, and their sample, the
    file's name. Files without records give no row; what is no BAM file is an error."""
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").option("splitbytes", str(split_bytes)).load(path).where("flag & 4 = 0 and seq <> '*'")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(sample, n) of all records, mapped or not, of each BAM file that has any."""
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").load(path).groupBy("sample").agg({"*": "count"}).withColumnRenamed("count(1)", "n")
