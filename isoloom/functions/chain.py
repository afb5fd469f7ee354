"""Column functions on splice chains, exons and sequences.

A chain is a dash-joined string of sites, exon end and next exon start in turn;
as a column here it is the array of its sites.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Complements of the IUPAC nucleotide codes.
IUPAC, COMPLEMENT = "ACGTRYKMBVDHSWNacgtrykmbvdhswn", "TGCAYRMKVBHDSWNtgcayrmkvbhdswn"


LOWER = "abcdefghijklmnopqrstuvwxyz"


def sites(chain: Column) -> Column:
    """Sites of a chain string; none where it is null or no list of integers."""
    good = F.coalesce(chain.rlike(r"^\d+(-\d+)*$"), F.lit(False))
    return F.when(good, F.split(chain, "-").cast("array<bigint>")).otherwise(F.array().cast("array<bigint>"))


def joined(values: Column, sep: str = "-") -> Column:
    return F.array_join(values.cast("array<string>"), sep)


def pairs(values: Column) -> Column:
    """Consecutive values two by two: structs (s, e); an odd last one is left out."""
    n = F.floor(F.size(values) / 2).cast("int")
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(F.get(values, 2 * i).alias("s"), F.get(values, 2 * i + 1).alias("e")))


def introns(chain: Column) -> Column:
    """Introns of a site array, none if its length is odd."""
    return F.when(F.size(chain) % 2 == 0, pairs(chain)).otherwise(F.array().cast("array<struct<s:bigint,e:bigint>>"))


def exons(start: Column, chain: Column, end: Column) -> Column:
    """Exons from transcript start, sites and end, ascending. An odd last site is left out."""
    even = F.slice(chain, 1, 2 * F.floor(F.size(chain) / 2).cast("int"))
    return pairs(F.concat(F.array(start.cast("bigint")), even, F.array(end.cast("bigint"))))


def all_sites(start: Column, chain: Column, end: Column) -> Column:
    """Sites of a chain and both ends, ascending; ends that are null are left out."""
    ends = F.array_compact(F.array(start.cast("bigint"), end.cast("bigint")))
    return F.array_sort(F.concat(chain, ends))


def windows(values: Column, k: int, every: int = 1) -> Column:
    """Slices of k values in a row, starting at each ``every``-th."""
    last = F.size(values) - k
    at = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(every))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.slice(values, i + 1, k))


def holds(whole: Column, part: Column) -> Column:
    """Whether ``part`` stands in ``whole`` as values in a row."""
    n = F.size(whole) - F.size(part)
    found = F.exists(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: F.slice(whole, i + 1, F.size(part)) == part)
    return F.when((n >= 0) & (F.size(part) > 0), found).otherwise(F.lit(False))


def is_sub_chain(part: Column, whole: Column) -> Column:
    """Whether the introns of ``part`` are some, but not all, introns in a row of ``whole``."""
    n = F.floor((F.size(whole) - F.size(part)) / 2).cast("int")
    found = F.exists(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: F.slice(whole, 2 * i + 1, F.size(part)) == part)
    return F.when((F.size(part) > 0) & (F.size(part) < F.size(whole)), found).otherwise(F.lit(False))


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two site arrays of one size."""
    square = F.zip_with(a, b, lambda x, y: ((x - y) * (x - y)).cast("double"))
    return F.sqrt(F.aggregate(square, F.lit(0.0), lambda s, x: s + x))


def reverse_complement(seq: Column, plain: bool = False) -> Column:
    """IUPAC and case are kept; ``plain``: a-z in upper case, only ACGTN change."""
    if plain:
        return F.reverse(F.translate(seq, LOWER + "ACGT", LOWER.upper().translate(str.maketrans("ACGT", "TGCA")) + "TGCA"))
    return F.reverse(F.translate(seq, IUPAC, COMPLEMENT))


def exon_lengths(ex: Column) -> Column:
    return F.transform(ex, lambda e: e["e"] - e["s"] + 1)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _cigar(text: pa.Array) -> pa.Array:
    """The structs of ``cigar`` for a batch of strings, whose operations are laid out in one row."""
    rows, given = len(text), text.is_valid()
    text = text.fill_null("").cast(pa.large_string())
    at = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + rows + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    row_of, starts = np.repeat(np.arange(rows), np.diff(at)), at - at[0]
    digit = (data >= 48) & (data <= 57)
    # an operation is a letter right behind a digit of its row
    ops = np.flatnonzero(np.isin(data[1:], list(b"MIDNSHP=X")) & digit[:-1] & (row_of[1:] == row_of[:-1])) + 1
    row, op = row_of[ops], data[ops]
    n, here, place = np.zeros(len(ops), np.int64), np.ones(len(ops), bool), 0
    while here.any():
        place += 1
        here = here & (ops - place >= starts[row])
        here[here] = digit[(ops - place)[here]]
        value = np.where(here, data[np.where(here, ops - place, 0)].astype(np.int64) - 48, 0) if len(ops) else n
        if place > 18 and value.any():
            raise OverflowError("a CIGAR operation has more than 18 digits")
        n += value * 10 ** min(place - 1, 17)
    first = np.searchsorted(row, np.arange(rows + 1))
    upto = lambda of: np.concatenate([[0], np.cumsum(np.where(np.isin(op, list(of)), n, 0))]).astype(np.int64)
    each = lambda c: c[first[1:]] - c[first[:-1]]
    moved = upto(b"MDNP=X")
    gap = np.flatnonzero(op == ord("N"))
    ends = np.concatenate([[0], np.cumsum(1 + np.bincount(row[gap], minlength=rows))]).astype(np.int64)
    s, e = np.zeros(ends[-1], np.int64), np.zeros(ends[-1], np.int64)
    begins, stops = np.zeros(ends[-1], bool), np.zeros(ends[-1], bool)
    begins[ends[:-1]], stops[ends[1:] - 1] = True, True
    s[~begins], e[~stops], e[stops] = moved[gap + 1] - moved[first[row[gap]]], moved[gap] - moved[first[row[gap]]], each(moved)
    exons = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(s), pa.array(e)], ["s", "e"]))
    sums = [pa.array(each(c)) for c in (upto(b"MI"), upto(b"SH"), moved)]
    return pa.StructArray.from_arrays([exons, *sums], ["exons", "covered", "clipped", "spanned"], mask=pc.invert(given))


def cigar(text: Column) -> Column:
    """struct<exons, covered, clipped, spanned> offsets of a CIGAR string, first base 0.

    M, D, N and = X P move along the reference; N ends an exon block; M and I
    count as covered; S and H as clipped. What is no operation is passed over, and null
    gives null. Batches are taken apart by numpy, since lambdas over the operations of a
    string are interpreted one by one.
    """
    return F.arrow_udf(_cigar, "struct<exons:array<struct<s:bigint,e:bigint>>,covered:bigint,clipped:bigint,spanned:bigint>")(text)


def primed_inside(window: Column) -> Column:
    """Whether 20 bases after a transcript's end could have primed it: six As in a row,
    60 percent As, or fewer than 10 bases known."""
    w = F.translate(window, LOWER, LOWER.upper())  # upper() may make two letters of one
    share = (F.length(w) - F.length(F.replace(w, F.lit("A"), F.lit("")))) / F.length(w)
    return F.coalesce((F.length(w) < 10) | F.contains(w, F.lit("AAAAAA")) | (share >= 0.6), F.lit(True))


def peak(profile: Column, reach: int, least: float = 0.01) -> Column:
    """struct<offset, height> of the highest strict local maximum within ``reach`` of the
    profile's middle and not below ``least``; null if there is none. Ties: the leftmost."""
    middle = F.floor(F.size(profile) / 2).cast("int")
    at = F.filter(F.sequence(middle - reach, middle + reach), lambda i: (i > 0) & (i < F.size(profile) - 1) & (F.get(profile, i) > F.get(profile, i - 1)) & (F.get(profile, i) > F.get(profile, i + 1)) & (F.get(profile, i) >= least))
    best = F.array_max(F.transform(at, lambda i: F.struct(F.get(profile, i).cast("double").alias("height"), (-i).alias("left"))))
    return F.when(best.isNotNull(), F.struct((-best["left"] - middle).alias("offset"), F.round(best["height"], 4).alias("height")))


def best_scored(sites: Column, limit: float) -> Column:
    """The best of sites (at, score), best first: the ``limit`` best, or for a limit below
    1 all with at least that score. Of equal scores, the later site comes first."""
    ordered = F.reverse(F.array_sort(F.transform(sites, lambda x: F.struct(x["score"].alias("score"), x["at"].alias("at")))))
    chosen = F.slice(ordered, 1, int(limit)) if limit >= 1 else F.filter(ordered, lambda x: x["score"] >= limit)
    return F.transform(chosen, lambda x: F.struct(x["at"].alias("at"), F.round(x["score"], 6).alias("score")))


def orfs(tis: Column, tts: Column) -> Column:
    """All (start, stop) pairs with a length that is positive and a multiple of three."""
    return F.flatten(F.transform(tis, lambda a: F.transform(F.filter(tts, lambda b: (b["at"] > a["at"]) & ((b["at"] - a["at"]) % 3 == 0)), lambda b: F.struct(a["at"].alias("tis"), b["at"].alias("tts"), a["score"].alias("tis_score"), b["score"].alias("tts_score")))))


def nmd(ex: Column, strand: Column, tis_score: Column, tts_score: Column, tts: Column, threshold: float = 0.9, junction: int = 55, utr3: int = 1000) -> Column:
    """no_orf without two good scores; NMD if the stop is ``junction`` or more before the last
    junction, or the 3' end over ``utr3`` behind it; else Normal."""
    sizes = exon_lengths(ex)
    length = total(sizes)
    last = F.when(strand == "-", F.get(sizes, F.lit(0))).otherwise(F.element_at(sizes, -1))
    bad = tis_score.isNull() | tts_score.isNull() | tts.isNull() | (tis_score < threshold) | (tts_score < threshold)
    decays = ((F.size(ex) > 1) & (tts <= length - last - junction)) | (length - tts > utr3)
    return F.when(bad, "no_orf").when(decays, "NMD").otherwise("Normal")


def segments(ex: Column, strand: Column, lo: Column, hi: Column) -> Column:
    """Genomic pieces of transcript offsets lo..hi (1-based, from the 5' end), ascending."""
    sizes = exon_lengths(ex)
    length = total(sizes)
    # on the minus strand offsets count from the other end
    a = F.when(strand == "-", length - hi + 1).otherwise(lo)
    b = F.when(strand == "-", length - lo + 1).otherwise(hi)
    at = F.sequence(F.lit(0), F.size(ex) - 1)
    cut = F.transform(at, lambda i: F.struct(total(F.slice(sizes, 1, i)).alias("before"), F.get(ex, i).alias("x")))
    out = F.transform(cut, lambda c: F.struct(F.greatest(c["x"]["s"], c["x"]["s"] + a - 1 - c["before"]).alias("s"), F.least(c["x"]["e"], c["x"]["s"] + b - 1 - c["before"]).alias("e")))
    return F.filter(out, lambda c: c["s"] <= c["e"])


def bounded_id(ids: Column, prefix: str, sep: str = "_", budget: int = 200) -> Column:
    """Sorted ids joined, or an alias by SHA-1 where that has more than ``budget`` bytes."""
    whole = F.array_join(F.array_sort(ids), sep)
    return F.when(F.octet_length(whole) <= budget, whole).otherwise(F.concat(F.lit(prefix), F.substring(F.sha1(whole.cast("binary")), 1, 12)))
