"""Graph filters of a locus that leave alone what a reference knows, and the drivers that put them together.

Chains have a column known (``mark_known``). A locus with any known chain is judged with the reference's
limits and protection, one without by reads alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloom.functions import chain
from isoloom.operators import chains as C
from isoloom.operators.chains import KEY, LOCUS
from isoloom.stages import Staged


def mark_known(chains: DataFrame, reference: DataFrame | None) -> DataFrame:
    """Adds known: whether the reference has the chain; false everywhere without one."""
    if reference is None:
        return chains.withColumn("known", F.lit(False))
    marks = reference.select(*KEY, F.lit(True).alias("known")).distinct()
    return chains.join(marks, KEY, "left").withColumn("known", F.coalesce("known", F.lit(False)))


def _guided(chains: DataFrame) -> DataFrame:
    """Adds guided: whether the locus has a known chain."""
    return chains.withColumn("guided", F.bool_or("known").over(Window.partitionBy(*LOCUS)))


def _limit(free: float, guided: float) -> Column:
    return F.when(F.col("guided"), guided).otherwise(free)


def error_sites(chains: DataFrame, apart: int = 10, ratio: float = 0.05, ratio_ref: float = 0.1) -> DataFrame:
    """(locus, site): sites at most ``apart`` from the next one of their locus that have at most ``ratio`` of
    its reads, or ``ratio_ref`` in a locus with known chains. Sites of known chains never are errors.

    Of two sites with equal reads the left one is the lower. No chains give no site.
    """
    sites = _guided(chains).select(*LOCUS, "guided", "known", "frequency", F.explode(chain.sites(F.col("SSC"))).alias("site"))
    f = sites.groupBy(*LOCUS, "site").agg(F.sum("frequency").alias("f"), F.bool_or("known").alias("known"), F.bool_or("guided").alias("guided"))
    w = Window.partitionBy(*LOCUS).orderBy("site")
    here, there = F.struct("f", "site", "known"), F.lead(F.struct("f", "site", "known")).over(w)
    near = f.withColumns({"a": here, "b": there}).where(F.col("b.site") - F.col("a.site") <= apart)
    low, high = F.when(F.col("a.f") <= F.col("b.f"), F.col("a")).otherwise(F.col("b")), F.greatest("a.f", "b.f")
    return near.where((low["f"] / high <= _limit(ratio, ratio_ref)) & ~low["known"]).select(*LOCUS, low["site"].alias("site")).distinct()


def _windows(chains: DataFrame, k: int, first: Column | None = None) -> DataFrame:
    """(locus, guided, p, n, top, least, known_top): windows of k extended sites, with the reads of all their
    chains, of the one with most and with least, and of the known one with most. ``first`` is asked of a
    window's place, from 0."""
    ext = C.extend(_guided(chains))
    all_ = F.transform(chain.windows(F.col("ext"), k), lambda p, i: F.struct(p.alias("p"), i.alias("i")))
    p = ext.select(*LOCUS, "guided", "known", "frequency", F.size("ext").alias("size"), F.explode(all_).alias("w")).select("*", "w.p", "w.i")
    p = p.where(first) if first is not None else p
    of_known = F.when(F.col("known"), F.col("frequency"))
    return p.groupBy(*LOCUS, "guided", "p").agg(F.sum("frequency").alias("n"), F.max("frequency").alias("top"), F.min("frequency").alias("least"), F.max(of_known).alias("known_top"))


def jump_errors(chains: DataFrame, little: int = 30, ratio: float = 0.05, ratio_ref: float = 0.1) -> DataFrame:
    """(locus, fragment): between an exon end and an exon start, the rarer of the jump and of all paths over
    one exon of at most ``little`` together, where it has less than the limit's share of the other.

    Of the paths the one of the chain with fewest reads is given (ties: the smaller). If a known chain has
    such a path, only a rarer jump is an error.
    """
    over = _windows(chains, 4, (F.col("i") % 2 == 1) & (F.col("p")[2] - F.col("p")[1] <= little))
    over = over.groupBy(*LOCUS, "guided", F.col("p")[0].alias("a"), F.col("p")[3].alias("d")).agg(F.sum("n").alias("n"), F.max("known_top").isNotNull().alias("known"), F.min(F.struct("least", "p"))["p"].alias("rarest"))
    jump = _windows(chains, 2).select(*LOCUS, F.col("p")[0].alias("a"), F.col("p")[1].alias("d"), F.col("n").alias("jump"))
    both = over.join(jump, [*LOCUS, "a", "d"])
    rare = F.least("n", "jump") / F.greatest("n", "jump") < _limit(ratio, ratio_ref)
    jumps = F.col("n") >= F.col("jump")  # the jump is the rarer one
    hit = both.where(rare & (jumps | ~(F.col("guided") & F.col("known"))))
    return hit.select(*LOCUS, F.when(jumps, F.array("a", "d")).otherwise(F.col("rarest")).alias("fragment")).distinct()


def misaligned_errors(chains: DataFrame, little: int = 30, apart: int = 10, ratio: float = 0.05, ratio_ref: float = 0.1) -> DataFrame:
    """(locus, fragment): of three exons in a row of which the middle one is at most ``little``, and two exons
    from the same start to the same end with other sites and at most ``apart`` more or fewer bases, the inner
    sites of the rarer, where one of its chains has less than the limit's share of a chain of the other. In
    a locus with known chains the other must be known."""
    six = _windows(chains, 6, (F.col("i") % 2 == 0) & (F.col("i") + 6 < F.col("size")) & (F.col("p")[3] - F.col("p")[2] <= little))
    four = _windows(chains, 4)
    bases = lambda k: sum((F.col("p")[i + 1] - F.col("p")[i] for i in range(0, k, 2)), F.lit(0))
    best = F.when(F.col("guided"), F.col("known_top")).otherwise(F.col("top"))
    side = lambda t, k: t.select(*LOCUS, F.col("p")[0].alias("a"), F.col("p")[k - 1].alias("z"), *(["guided"] if k == 6 else []), F.col("p").alias(f"p{k}"), bases(k).alias(f"n{k}"), F.col("least").alias(f"low{k}"), best.alias(f"top{k}"))
    both = side(six, 6).join(side(four, 4), [*LOCUS, "a", "z"]).where((F.abs(F.col("n6") - F.col("n4")) <= apart) & (F.size(F.array_except("p4", "p6")) > 0))
    share = lambda low, top: F.coalesce(F.col(low) / F.col(top) < _limit(ratio, ratio_ref), F.lit(False))
    none = F.array().cast("array<array<bigint>>")
    hits = F.concat(F.when(share("low4", "top6"), F.array(F.slice("p4", 2, 2))).otherwise(none), F.when(share("low6", "top4"), F.array(F.slice("p6", 2, 4))).otherwise(none))
    return both.select(*LOCUS, F.explode(hits).alias("fragment")).distinct()


def drop_fragments(chains: DataFrame, bad: DataFrame) -> DataFrame:
    """Chains whose own sites, not the extended ones, hold none of the fragments as sites in a row."""
    sites = chain.sites(F.col("SSC"))
    parts = chains.select(*KEY, "Group", F.explode(F.concat(*[chain.windows(sites, k) for k in (2, 4, 6)])).alias("fragment"))
    gone = parts.join(bad, [*LOCUS, "fragment"], "left_semi").select(*KEY).distinct()
    return chains.join(gone, KEY, "left_anti")


def filter_graph(raw: DataFrame, chains: DataFrame, reference: DataFrame | None = None, quantile: float = 0.25, staged: Staged | None = None) -> DataFrame:
    """Chains that the splice graphs of their loci bear out, with category where there is a reference.

    With a reference its chains come back from ``raw``, loci with few reads go unless it has a chain there,
    and chains that it knows (FSM) shape the graphs. Then chains with error sites go, those with little exons
    jumped or misaligned, and those with the rarer of two forked paths. A locus is that of the table given;
    raw and chains have Group from the same numbering. No chains give none.
    """
    staged = staged or Staged(chains.sparkSession, "graph")
    names = chains.columns
    if reference is not None:
        chains = C.rescue_known(raw, chains, reference)
    chains = staged.write(mark_known(C.keep_loci(chains, reference, quantile), reference), "kept")
    chains = staged.write(C.drop_sites(chains, error_sites(chains)), "sites")
    little = jump_errors(chains).unionByName(misaligned_errors(chains))
    pairs = staged.write(C.fork_pairs(chains), "forks")
    forks = C.exon_jump_errors(pairs).unionByName(C.fake_exon_errors(pairs))
    out = staged.write(drop_fragments(chains, little.unionByName(forks)), "chains")
    out = out.select(*names)
    return C.categories(out, reference) if reference is not None else out
