"""BAM files written here, read in many ranges, against the SAM text of the same records."""

import random
import struct
import zlib

import pyarrow as pa
import pytest

from isoloom.operators import alignments as A
from isoloom.sources import bam, tables

OPS, BASES = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"
EOF = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
CONTIGS = [("chr1", 5000), ("chr2", 900_000)]


def member(data):
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    return struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def packed(r):
    name, flag, chrom, pos, cigar, seq, tags = r
    ref = [c for c, _ in CONTIGS].index(chrom) if chrom != "*" else -1
    ops = [] if cigar == "*" else [(int(n), OPS.index(o)) for n, o in cigar]
    bases = "" if seq == "*" else seq
    nibbles = [BASES.index(c) for c in bases] + [0] * (len(bases) % 2)
    raw = struct.pack("<iiBBHHHiiii", ref, pos - 1, len(name) + 1, 60, 0, len(ops), flag, len(bases), -1, -1, 0) + name.encode() + b"\0"
    raw += b"".join(struct.pack("<I", n << 4 | o) for n, o in ops) + bytes(nibbles[i] << 4 | nibbles[i + 1] for i in range(0, len(nibbles), 2)) + bytes([30] * len(bases))
    for tag, (kind, value) in tags.items():
        raw += tag.encode() + kind.encode()
        raw += value.encode() + b"\0" if kind == "Z" else value.encode() if kind == "A" else struct.pack("<BI3i", ord("i"), 3, 1, 2, 3) if kind == "B" else struct.pack({"c": "<b", "C": "<B", "S": "<H", "i": "<i", "f": "<f"}[kind], value)
    return struct.pack("<i", len(raw)) + raw


def made(n=300, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.choice([1, 20, 33, 80, 400, 3000 if i % 9 == 0 else 50])
        a = rng.randint(0, size - 1)
        cigar = [(a, "S")] * (a > 0) + [(size - a, "M")]
        if size > 40 and a < size - 20:
            cigar = [(a, "S")] * (a > 0) + [(10, "M"), (300, "N"), (size - a - 10, "M")]
        tags = {"NM": (rng.choice("cCSi"), rng.randint(0, 9)), "ZB": ("B", None), "zf": ("f", 1.5), "RG": ("Z", "some group")}
        if rng.random() < 0.6:
            tags["ts"] = ("A", rng.choice("+-"))
        if rng.random() < 0.5:
            tags["pt"] = ("i", rng.randint(-1, 200))
        if rng.random() < 0.1:
            tags["XS"] = ("A", "-")
        flag = rng.choice([0, 16, 256, 4 if i % 20 == 0 else 0])
        seq = "".join(rng.choice("ACGTN") for _ in range(size)) if i % 31 else "*"
        out.append((f"read/{i}", flag, rng.choice(["chr1", "chr2"]) if flag != 4 else "*", rng.randint(1, 4000) if flag != 4 else 0, cigar if flag != 4 else "*", seq, tags))
    return out


def write_bam(path, rows, block, header="@HD\tVN:1.6\n"):
    text = header.encode()
    data = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(CONTIGS)) + b"".join(struct.pack("<i", len(c) + 1) + c.encode() + b"\0" + struct.pack("<i", n) for c, n in CONTIGS)
    data += b"".join(map(packed, rows))
    path.write_bytes(b"".join(member(data[i : i + block]) for i in range(0, len(data), block)) + EOF)


def write_sam(path, rows):
    lines = ["@HD\tVN:1.6"]
    for name, flag, chrom, pos, cigar, seq, tags in rows:
        said = [f"{t}:{'i' if k in 'cCSi' else k}:{v}" for t, (k, v) in tags.items() if k not in "Bf"]
        lines.append("\t".join([name, str(flag), chrom, str(pos), "60", "*" if cigar == "*" else "".join(f"{n}{o}" for n, o in cigar), "*", "0", "0", seq, "*", *said]))
    path.write_text("\n".join(lines) + "\n")


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [200, 1500, 60_000])
def test_ranges_agree_with_sam(spark, tmp_path, block):
    rows = made()
    write_bam(tmp_path / "s1.bam", rows, block)
    write_sam(tmp_path / "s1.sam", rows)
    sam = tables.read_sam(spark, str(tmp_path / "s1.sam"))
    for split in (700, 5000, 1 << 26):
        got = bam.read_bam(spark, str(tmp_path / "s1.bam"), split)
        assert split == 1 << 26 or got.rdd.getNumPartitions() > 3
        assert listed(got.select(*sam.columns)) == listed(sam)
    assert listed(A.to_reads(got)) == listed(A.to_reads(sam))


def test_each_record_once_in_every_range(tmp_path):
    """Ranges of any size, also within one member and within the header."""
    rows = made(80, 5)
    path = tmp_path / "x.bam"
    write_bam(path, rows, 350, "@CO\t" + "x" * 2000 + "\n")
    file = pa.OSFile(str(path))
    want = [r[0] for r in rows]
    for step in (97, 333, 1000, 10**6):
        assert [r[0] for lo in range(0, file.size(), step) for r in bam.records(file, lo, lo + step)] == want


def test_long_cigars_and_odd_files(spark, tmp_path):
    ops = [(1, "M"), (1, "I")] * 50
    raw = packed(("a", 0, "chr1", 7, [(100, "S"), (50, "N")], "AC" * 50, {}))[4:] + b"CGBI" + struct.pack("<I", 100) + b"".join(struct.pack("<I", n << 4 | OPS.index(o)) for n, o in ops)
    assert bam.decode(raw, ["chr1"])[4] == "1M1I" * 50
    write_bam(tmp_path / "none.bam", [], 100)
    write_bam(tmp_path / "two.bam", made(2, 3), 10_000)
    assert bam.read_bam(spark, str(tmp_path / "none.bam"), 40).count() == 0
    # a folder, with the files' names as samples; unmapped records and those without sequence count
    assert {tuple(r) for r in bam.read_counts(spark, str(tmp_path)).collect()} == {("two", 2)}
    assert bam.read_bam(spark, f"file://{tmp_path}/two.bam").where("sample = 'two'").count() == sum(r[1] != 4 and r[5] != "*" for r in made(2, 3))
    (tmp_path / "bad.bam").write_bytes(member(b"something else"))
    with pytest.raises(Exception, match="not a BAM file"):
        bam.read_bam(spark, str(tmp_path / "bad.bam")).count()
    whole = (tmp_path / "two.bam").read_bytes()
    (tmp_path / "cut.bam").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception):
        bam.read_bam(spark, str(tmp_path / "cut.bam")).count()


def test_ingest(spark, tmp_path):
    from isoloom.operators import guards
    from isoloom.plans.ingest import ingest

    (tmp_path / "bams").mkdir()
    rows = made(200, 9)
    write_bam(tmp_path / "bams" / "s1.bam", rows, 1500)
    write_bam(tmp_path / "bams" / "s2.bam", [(*r[:6], {k: v for k, v in r[6].items() if k != "pt"}) for r in rows[:50]], 60_000)
    rng = random.Random(2)
    genome = {c: "".join(rng.choice("ACGT") for _ in range(9000)) for c, _ in CONTIGS}
    (tmp_path / "g.fa").write_text("".join(f">{c}\n{s}\n" for c, s in genome.items()))
    got = ingest(spark, str(tmp_path / "bams"), str(tmp_path / "g.fa"), str(tmp_path / "out"), 4000)
    mapped = [r for r in rows if r[1] != 4 and r[5] != "*"]
    assert {r.sample: r["count"] for r in got.reads.groupBy("sample").count().collect()} == {"s1": len(mapped), "s2": sum(r in mapped for r in rows[:50])}
    assert {(r.sample, r.has_polya) for r in got.tails.collect()} == {("s1", True), ("s2", False)}
    chains = {(r.sample, r.Chr, r.Strand, r.SSC): 0 for r in got.reads.where("SSC is not null").collect()}
    for r in got.reads.where("SSC is not null").collect():
        chains[r.sample, r.Chr, r.Strand, r.SSC] += 1
    assert {(r.sample, r.Chr, r.Strand, r.SSC): r["count"] for r in got.junctions.collect()} == chains and chains
    turn = str.maketrans("ACGT", "TGCA")
    for r in got.junctions.collect():
        a, b = map(int, r.SSC.split("-"))
        left, right = genome[r.Chr][a : a + 2], genome[r.Chr][b - 3 : b - 1]
        assert r.junction == (f"{right.translate(turn)[::-1]}-{left.translate(turn)[::-1]}" if r.Strand == "-" else f"{left}-{right}")
    (tmp_path / "other.fa").write_text(">1\nACGT\n>2\nACGT\n")
    with pytest.raises(guards.ContigError):
        ingest(spark, str(tmp_path / "bams"), str(tmp_path / "other.fa"), str(tmp_path / "out2"))
