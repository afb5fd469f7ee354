"""Transcript ends, read correction and poly(A) evidence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloom.functions import chain
from isoloom.operators.chains import KEY
from isoloom.stages import Staged


def modes(reads: DataFrame) -> DataFrame:
    """Most frequent start and end of each chain: of ties the outermost."""
    return reads.where("SSC is not null").groupBy(*KEY).agg(F.expr("mode() within group (order by TrStart)").alias("start_mode"), F.expr("mode() within group (order by TrEnd desc)").alias("end_mode"))


def clusters(values: DataFrame, keys: list[str], value: str, eps: int = 15, least: int = 20, share: float = 0.1, n: str | None = None) -> DataFrame:
    """Adds cluster to rows of values: density clusters in one dimension, null for noise.

    A value is core if max(floor(share * n), least) rows, itself included, lie within
    eps. Cores at most eps apart share a cluster; other values take that of the
    nearest core within eps, of ties the lower. Windows run on distinct values. ``n`` is the
    column that counts the rows that a row stands for.
    """
    v = values.groupBy(*keys, value).agg((F.sum(n) if n else F.count("*")).alias("n"))
    return values.join(_clustered(v, keys, value, eps, least, share).select(*keys, value, "cluster"), [*keys, value])


def _clustered(v: DataFrame, keys: list[str], value: str, eps: int = 15, least: int = 20, share: float = 0.1) -> DataFrame:
    """(keys, value, n) with cluster, as ``clusters`` finds it, for distinct values counted by n; rows with a
    null key or value are left out. All of it are windows over a key in order of the value, up or down, that
    keep running values, so that rows are moved once and no frame is read again for each row."""
    up, down = (Window.partitionBy(*keys).orderBy(by) for by in (F.col(value), F.col(value).desc()))
    before, until = (Window.unboundedPreceding, -1), (Window.unboundedPreceding, 0)
    v = v.withColumns({"_all": F.sum("n").over(Window.partitionBy(*keys)), "_near": F.sum("n").over(up.rangeBetween(-eps, eps))})
    v = v.withColumn("_core", F.col(value).isNotNull() & (F.col("_near") >= F.greatest(F.floor(F.col("_all") * share), F.lit(least))))
    last = F.last(F.when(F.col("_core"), F.col(value)), True).over(up.rowsBetween(*before))
    v = v.withColumn("_new", F.when(F.col("_core"), F.coalesce((F.col(value) - last > eps).cast("int"), F.lit(0))))
    v = v.withColumn("_own", F.when(F.col("_core"), F.sum("_new").over(up.rowsBetween(*until))))
    at = F.when(F.col("_core"), F.struct(F.col(value).alias("v"), F.col("_own").alias("own")))
    v = v.withColumn("_below", F.last(at, True).over(up.rowsBetween(*until))).withColumn("_above", F.last(at, True).over(down.rowsBetween(*until)))
    fall, rise = F.col(value) - F.col("_below.v"), F.col("_above.v") - F.col(value)
    pick = F.when(F.col("_core"), F.col("_own")).when((fall <= eps) & (rise.isNull() | (fall <= rise)), F.col("_below.own")).when(rise <= eps, F.col("_above.own")).when(fall <= eps, F.col("_below.own"))
    whole = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in (*keys, value)))
    return v.where(whole).select(*keys, value, "n", pick.alias("cluster"))


def _sites(v: DataFrame, keys: list[str], outer: Column) -> DataFrame:
    """(keys, cluster, site, n) of (keys, value, n): each cluster's most frequent value, of ties the one with least ``outer``."""
    c = _clustered(v, keys, "value").where("cluster is not null")
    return c.groupBy(*keys, "cluster").agg(F.min_by("value", F.struct(-F.col("n"), outer)).alias("site"), F.sum("n").alias("n"))


def terminal_sites(reads: DataFrame, side: str, n: str | None = None) -> DataFrame:
    """(chain, cluster, site, n): most frequent value of each cluster of read starts or ends, of ties the
    outermost. ``n`` is the column that counts the reads of a row, where rows are not single reads."""
    value = F.col("TrStart" if side == "start" else "TrEnd")
    given = reads.where("SSC is not null").groupBy(*KEY, value.alias("value")).agg((F.sum(n) if n else F.count("*")).alias("n"))
    return _sites(given, KEY, F.col("value") if side == "start" else -F.col("value"))


def terminal_pairs(reads: DataFrame, n: str | None = None, paired: bool = False) -> DataFrame:
    """(chain, TrStart, TrEnd, frequency): pairs of clustered ends that reads have.

    One start and one end are a pair. Else pairs count that occur among the reads;
    a single one takes all reads, several share them by the distinct raw pairs
    nearest to each, rounded half to even, and without any the outermost clustered
    ends do. Chains without a cluster take their outermost reads. ``n`` is the column that
    counts the reads of a row, where rows are not single reads; ``paired`` says that there is one
    row for each chain and pair of ends, in a table that may be read several times. What a chain
    must know of its ends, of which few are clustered, is written as one row. It comes to the pairs
    in two joins: clustered ends, for the pairs that occur, and where several do, these.
    """
    staged = Staged(reads.sparkSession, "ends")
    raw = reads.where("SSC is not null")
    if paired:
        raw = raw.select(*KEY, "TrStart", "TrEnd", F.col(n).alias("n") if n else F.lit(1).cast("bigint").alias("n"))
    else:
        raw = staged.write(raw.groupBy(*KEY, "TrStart", "TrEnd").agg((F.sum(n) if n else F.count("*")).alias("n")), "raw")
    sides = F.array(F.struct(F.lit(True).alias("starts"), F.col("TrStart").alias("value")), F.struct(F.lit(False).alias("starts"), F.col("TrEnd").alias("value")))
    values = raw.select(*KEY, "n", F.explode(sides).alias("x")).groupBy(*KEY, "x.starts", "x.value").agg(F.sum("n").alias("n"))
    sites = _sites(values, [*KEY, "starts"], F.when(F.col("starts"), F.col("value")).otherwise(-F.col("value")))
    lists = sites.groupBy(*KEY).agg(F.collect_list(F.when(F.col("starts"), F.col("site"))).alias("s"), F.collect_list(F.when(~F.col("starts"), F.col("site"))).alias("e"))
    lists = staged.write(lists.where((F.size("s") > 0) & (F.size("e") > 0)), "sites")
    pair = F.struct(F.col("TrStart").alias("s"), F.col("TrEnd").alias("e"))
    seen = raw.join(lists.hint("shuffle_hash"), KEY).where(F.array_contains("s", F.col("TrStart")) & F.array_contains("e", F.col("TrEnd"))).groupBy(*KEY).agg(F.collect_list(pair).alias("seen"))
    whole = raw.groupBy(*KEY).agg(F.sum("n").alias("all"), F.count("*").alias("pairs"), F.min("TrStart").alias("lo"), F.max("TrEnd").alias("hi"))
    chains = whole.join(lists.select(*KEY, F.array_min("s").alias("s0"), F.array_max("e").alias("e0")), KEY, "left").join(seen, KEY, "left")
    chains = staged.write(chains, "chains")
    several = chains.where("size(seen) > 1")
    d = lambda x: (F.col("TrStart") - x["s"]) ** 2 + (F.col("TrEnd") - x["e"]) ** 2
    near = F.array_min(F.transform("seen", lambda x: F.struct(d(x).alias("d"), x["s"].alias("s"), x["e"].alias("e"))))
    own = raw.join(several.select(*KEY, "seen").hint("shuffle_hash"), KEY).select(*KEY, near.alias("c")).groupBy(*KEY, "c.s", "c.e").agg(F.count("*").alias("own"))
    own = own.join(several.select(*KEY, "all", "pairs"), KEY).select(*KEY, F.col("s").alias("TrStart"), F.col("e").alias("TrEnd"), F.bround(F.col("all") * F.col("own") / F.col("pairs")).cast("bigint").alias("frequency"))
    one = F.get("seen", F.lit(0))
    rest = chains.where("seen is null or size(seen) = 1").select(*KEY, F.coalesce(one["s"], "s0", "lo").alias("TrStart"), F.coalesce(one["e"], "e0", "hi").alias("TrEnd"), F.col("all").alias("frequency"))
    return own.unionByName(rest)


def nearest_chains(reads: DataFrame, model: DataFrame, most: float = 15.0) -> DataFrame:
    """(chain, model_SSC, distance): for each distinct read chain the nearest model chain of
    its strand and size within ``most``; of ties the smaller. The first sites of such
    chains lie that close, so bins of them are a key of the join."""
    width = int(most) + 1
    q = reads.where("SSC is not null").select(*KEY).distinct().withColumn("q", chain.sites(F.col("SSC")))
    q = q.withColumn("bin", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: F.floor(F.element_at("q", 1) / width) + i)))
    m = model.select("Chr", "Strand", F.col("SSC").alias("model_SSC")).distinct().withColumn("m", chain.sites(F.col("model_SSC")))
    m = m.withColumn("bin", F.floor(F.element_at("m", 1) / width))
    near = q.withColumn("n", F.size("q")).join(m.withColumn("n", F.size("m")), ["Chr", "Strand", "n", "bin"]).withColumn("distance", chain.distance(F.col("q"), F.col("m"))).where(F.col("distance") <= most)
    return near.groupBy(*KEY).agg(F.min(F.struct("distance", "model_SSC")).alias("x")).select(*KEY, "x.model_SSC", "x.distance")


def nearest_ends(reads: DataFrame, model: DataFrame, tolerance: float = 50.0) -> DataFrame:
    """(chain, TrStart, TrEnd, n, model_start, model_end): distinct read ends with the nearest
    model ends of the chain; null beyond ``tolerance``."""
    q = reads.where("SSC is not null").groupBy(*KEY, "TrStart", "TrEnd").agg(F.count("*").alias("n"))
    m = model.select(*KEY, F.col("TrStart").alias("ms"), F.col("TrEnd").alias("me"))
    d = F.sqrt((F.col("TrStart") - F.col("ms")) ** 2 + (F.col("TrEnd") - F.col("me")) ** 2)
    near = q.join(m, KEY).withColumn("d", d).groupBy(*KEY, "TrStart", "TrEnd", "n").agg(F.min(F.struct("d", "ms", "me")).alias("x"))
    close = F.col("x.d") <= tolerance
    return near.select(*KEY, "TrStart", "TrEnd", "n", F.when(close, F.col("x.ms")).alias("model_start"), F.when(close, F.col("x.me")).alias("model_end"))


def correct_reads(reads: DataFrame, model: DataFrame, site_tolerance: float = 15.0, end_tolerance: float = 100.0, chains: DataFrame | None = None) -> DataFrame:
    """Spliced reads with the chain of the nearest model chain of their strand and size, then
    with the nearest model ends of that chain, where these lie within the tolerances.

    Columns and the number of rows stay; of equally near chains or ends the smaller is
    taken. Single-exon reads (SSC null) are left out. A read that is near nothing stays
    as it is, and an empty model changes no read. Distances of chains are found once for each
    distinct chain, which are those of ``chains`` where a table has them already. The chain that a
    chain is moved to comes to its reads together with that one's model ends, as one array, so
    that reads are joined once. Ends of reads may lie twice as far off as those that
    ``nearest_ends`` takes for a terminal's.
    """
    names = reads.columns
    spliced = reads.where("SSC is not null")
    moved = nearest_chains(spliced if chains is None else chains, model, site_tolerance).where("model_SSC <> SSC").select(*KEY, F.col("model_SSC").alias("_to"))
    ends = model.groupBy(*KEY).agg(F.collect_set(F.struct(F.col("TrStart").alias("s"), F.col("TrEnd").alias("e"))).alias("_ends"))
    stays = model.select(*KEY, F.lit(None).cast("string").alias("_to"))
    to = moved.unionByName(stays).groupBy(*KEY).agg(F.max("_to").alias("_to")).withColumn("_to", F.coalesce("_to", "SSC"))
    to = to.join(ends.withColumnRenamed("SSC", "_to"), ["Chr", "Strand", "_to"])
    d = lambda x: F.sqrt((F.col("TrStart") - x["s"]) ** 2 + (F.col("TrEnd") - x["e"]) ** 2)
    near = F.array_min(F.transform("_ends", lambda x: F.struct(d(x).alias("d"), x["s"].alias("s"), x["e"].alias("e"))))
    fixed = spliced.join(to.hint("shuffle_hash"), KEY, "left").withColumn("_near", near)
    close = F.col("_near.d") <= end_tolerance
    return fixed.withColumns({"SSC": F.coalesce("_to", "SSC"), "TrStart": F.coalesce(F.when(close, F.col("_near.s")), "TrStart"), "TrEnd": F.coalesce(F.when(close, F.col("_near.e")), "TrEnd")}).select(*names)


def polya_fraction(reads: DataFrame, model: DataFrame, n: str | None = None, n_tails: str | None = None) -> DataFrame:
    """model with polyA_frac, the share of its corrected reads that have a tail, and how many have
    one (polyA_valid_reads). Reads belong to a transcript by chain and both ends; a transcript
    without reads was not measured: its polyA_frac is null, which is not the same as 0. ``n`` and
    ``n_tails`` are the columns that count the reads of a row and those with a tail, where rows
    are not single reads."""
    ends = [*KEY, "TrStart", "TrEnd"]
    f = reads.where("SSC is not null").groupBy(*ends).agg((F.sum(n_tails) if n_tails else F.count_if(F.col("polyA_len") > 0)).alias("polyA_valid_reads"), (F.sum(n) if n else F.count("*")).alias("_n"))
    out = model.join(f, ends, "left")
    return out.withColumns({"polyA_frac": F.col("polyA_valid_reads") / F.col("_n"), "polyA_valid_reads": F.coalesce("polyA_valid_reads", F.lit(0))}).drop("_n")


def polya_lengths(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Median and mean (one decimal) and number of tail lengths over 0."""
    t = reads.where("polyA_len > 0").groupBy(*keys)
    return t.agg(F.round(F.median("polyA_len"), 1).alias("polyA_median"), F.round(F.avg("polyA_len"), 1).alias("polyA_mean"), F.count("*").alias("polyA_count"))


def polya_profiles(reads: DataFrame, keys: list[str], n: str | None = None) -> DataFrame:
    """(keys, polyA_median, polyA_mean, polyA_count, lengths): tails over 0 of each key, lengths as an array of
    structs (length, n) in order.

    A key's row grows with the lengths that occur, not with its reads, so a key with a third of all
    reads is a short row, too. Median and mean have one decimal and are those of ``polya_lengths``.
    ``n`` is the column that counts the reads of a row, where rows are not single reads. Keys
    without tails have no row.
    """
    counted = reads.where("polyA_len > 0").groupBy(*keys, F.col("polyA_len").alias("length")).agg((F.sum(n) if n else F.count("*")).alias("n"))
    t = counted.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("length", "n"))).alias("lengths"))
    total = chain.total(F.transform("lengths", lambda x: x["n"]))
    t = t.withColumn("polyA_count", total)
    # the lengths that stand at a place, from 0, in the row of all tails
    upto = F.transform("lengths", lambda x, i: F.struct(chain.total(F.transform(F.slice("lengths", 1, i + 1), lambda y: y["n"])).alias("end"), x["length"].alias("length")))
    t = t.withColumn("upto", upto)
    at = lambda k: F.filter("upto", lambda x: x["end"] > k)[0]["length"]
    middle = (at(F.floor((F.col("polyA_count") - 1) / 2)) + at(F.floor(F.col("polyA_count") / 2))) / 2
    mean = F.aggregate("lengths", F.lit(0.0), lambda s, x: s + x["length"] * x["n"]) / F.col("polyA_count")
    return t.select(*keys, F.round(middle, 1).alias("polyA_median"), F.round(mean, 1).alias("polyA_mean"), "polyA_count", "lengths")


def single_exon_overlaps(single: DataFrame, multi: DataFrame, bin_width: int = 10_000) -> DataFrame:
    """single with is_intergenic_or_antisense: no multi-exon row of the strand overlaps
    [TrStart, TrEnd]. Both sides meet in the bins that they touch."""
    bins = lambda: F.sequence(F.floor(F.col("TrStart") / bin_width), F.floor(F.col("TrEnd") / bin_width))
    s = single.select("Chr", "Strand", "TrStart", "TrEnd").distinct().withColumn("bin", F.explode(bins()))
    m = multi.select("Chr", "Strand", "TrStart", "TrEnd").distinct().withColumn("bin", F.explode(bins())).select("Chr", "Strand", "bin", F.col("TrStart").alias("ms"), F.col("TrEnd").alias("me"))
    hit = s.join(m, ["Chr", "Strand", "bin"]).where("TrStart <= me and ms <= TrEnd").select("Chr", "Strand", "TrStart", "TrEnd", F.lit(False).alias("_free")).distinct()
    return single.join(hit, ["Chr", "Strand", "TrStart", "TrEnd"], "left").withColumn("is_intergenic_or_antisense", F.coalesce("_free", F.lit(True))).drop("_free")


def single_exon_reasons(single: DataFrame, filter_freq: int = 5, polya: float = 0.95, tss: float = 0.1) -> DataFrame:
    """Adds reason: the first rule that a single-exon transcript fails, or PASS."""
    reason = (
        F.when(~F.col("is_intergenic_or_antisense"), "P1_genic_overlap")
        .when(F.col("frequency") < max(15, 3 * filter_freq), "P4_low_freq")
        .when(F.abs(F.col("TrEnd") - F.col("TrStart")) + 1 < 200, "P5_short")
        .when(F.coalesce("tss_score", F.lit(0.0)) < tss, "P2_weak_tss")
        .when(~((F.col("polyA_frac") >= polya) & (F.col("polyA_valid_reads") >= 3)) & F.coalesce("primed_inside", F.lit(True)), "P3_polya_fail")
        .otherwise("PASS")
    )
    return single.withColumn("reason", reason)
