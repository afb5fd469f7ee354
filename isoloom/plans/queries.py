"""Registered queries over the driver tables, each with DuckDB SQL for the same rows."""

from __future__ import annotations

import uuid
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloom.functions import chain
from isoloom.operators import alignments as A
from isoloom.operators import annotate as N
from isoloom.operators import chains as C
from isoloom.operators import curate as U
from isoloom.operators import graphs, guards
from isoloom.operators import guided as H
from isoloom.operators import quantify as Q
from isoloom.operators import remap as R
from isoloom.operators import reports as P
from isoloom.operators import scores as X
from isoloom.operators import termini as T
from isoloom.sources import tables
from isoloom.stages import Staged, shared_dir

QUERIES: dict = {}
SQL: dict[str, str] = {}

BASE = "WITH RECURSIVE reads AS (" + tables.READS_SQL.replace("{lineitem}", "lineitem") + """),
q AS (SELECT * FROM reads WHERE identity >= 0.95 AND coverage >= 0),
c AS (SELECT Chr, Strand, SSC, count(*) AS frequency, min(TrStart) AS lo, max(TrEnd) AS hi FROM q WHERE SSC IS NOT NULL GROUP BY Chr, Strand, SSC),
st AS (SELECT *, CAST(string_split(SSC, '-') AS BIGINT[]) AS t FROM c),
isl AS (SELECT *, CASE WHEN t[1] > max(t[-1]) OVER (PARTITION BY Chr, Strand ORDER BY t[1], t[-1], SSC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS nw FROM st),
loc AS (SELECT *, sum(nw) OVER (PARTITION BY Chr, Strand ORDER BY t[1], t[-1], SSC ROWS UNBOUNDED PRECEDING) AS l FROM isl),
g AS (SELECT Chr, Strand, SSC, frequency, lo, hi, t, CAST(dense_rank() OVER (ORDER BY Chr, Strand, l) - 1 AS BIGINT) AS grp FROM loc),
mo AS (SELECT *, CASE WHEN frequency % 11 = 0 THEN 'none' ELSE array_to_string(list_transform(range(len(t) // 2), lambda i: CASE WHEN frequency % 3 = 0 THEN 'ct-ac' WHEN frequency % 2 = 0 THEN 'gc-ag' ELSE 'GT-AG' END), ',') END AS junction FROM g),
ref AS (SELECT * FROM g WHERE frequency >= 20 AND grp % 2 = 0 AND len(t) >= 4),
model AS (SELECT *, concat('G', CAST(grp AS VARCHAR)) AS GeneID, concat('G', CAST(grp AS VARCHAR), '_', SSC) AS TrID FROM g WHERE frequency >= 20),
e AS (SELECT Chr, Strand, grp, t[i] AS u, t[i+1] AS v, frequency / sum(frequency) OVER () AS x, frequency FROM (SELECT *, unnest(range(1, len(t))) AS i FROM g)),
ew AS (SELECT a.Chr, a.Strand, a.grp, u, v, sum(a.frequency / b.f) AS weight FROM e a JOIN (SELECT grp, sum(frequency) AS f FROM g GROUP BY grp) b USING (grp) GROUP BY ALL),
ex AS (SELECT *, list_concat([min(t[1]) OVER (PARTITION BY grp) - 100], t, [max(t[-1]) OVER (PARTITION BY grp) + 100]) AS ext FROM g),
sf AS (SELECT Chr, Strand, grp, site, sum(frequency) AS f FROM (SELECT *, unnest(t) AS site FROM g) GROUP BY ALL),
w2 AS (SELECT Chr, Strand, grp, ext[i:i+1] AS p, CAST(sum(frequency) AS BIGINT) AS f FROM (SELECT *, unnest(range(2, len(ext), 2)) AS i FROM ex) GROUP BY ALL),
w4 AS (SELECT Chr, Strand, grp, ext[i:i+3] AS p, CAST(sum(frequency) AS BIGINT) AS f FROM (SELECT *, unnest(range(2, len(ext) - 2, 2)) AS i FROM ex) GROUP BY ALL),
w6 AS (SELECT Chr, Strand, grp, ext[i:i+5] AS p, CAST(sum(frequency) AS BIGINT) AS f FROM (SELECT *, unnest(range(2, len(ext) - 4, 2)) AS i FROM ex) GROUP BY ALL),
bysample AS (SELECT sample, Chr, Strand, SSC, count(*) AS frequency, min(TrStart) AS lo, max(TrEnd) AS hi FROM q WHERE SSC IS NOT NULL GROUP BY ALL),
src AS (SELECT a.grp, a.SSC, b.SSC AS source, b.frequency AS sf FROM g a JOIN g b ON a.grp = b.grp AND len(a.t) < len(b.t) WHERE len(list_filter(range(0, (len(b.t) - len(a.t)) // 2 + 1), lambda j: b.t[2*j+1 : 2*j+len(a.t)] = a.t)) > 0),
model_tr AS (SELECT r.Chr, r.Strand, r.SSC, GeneID, concat(TrID, CASE WHEN r.TrEnd % 4000 >= 1500 THEN '_far' ELSE '' END) AS TrID, min(r.TrStart) AS TrStart, max(r.TrEnd) AS TrEnd FROM q r JOIN model USING (Chr, Strand, SSC) GROUP BY ALL),
near_chain AS (SELECT st.Chr, st.Strand, st.SSC, min({'d': list_distance(CAST(st.t AS DOUBLE[]), CAST(m.t AS DOUBLE[])), 's': m.SSC}).s AS near FROM st JOIN model m ON m.Chr = st.Chr AND m.Strand = st.Strand AND len(m.t) = len(st.t)
WHERE list_distance(CAST(st.t AS DOUBLE[]), CAST(m.t AS DOUBLE[])) <= 15 GROUP BY ALL),
read_chain AS (SELECT sample, q.Chr, q.Strand, coalesce(near, q.SSC) AS SSC, TrStart, TrEnd, polyA_len FROM q LEFT JOIN near_chain ON near_chain.Chr = q.Chr AND near_chain.Strand = q.Strand AND near_chain.SSC = q.SSC WHERE q.SSC IS NOT NULL),
near_ends AS (SELECT r.Chr, r.Strand, r.SSC, r.TrStart, r.TrEnd, min({'d': sqrt((r.TrStart - model_tr.TrStart)**2 + (r.TrEnd - model_tr.TrEnd)**2), 's': model_tr.TrStart, 'e': model_tr.TrEnd}) AS x FROM (SELECT DISTINCT Chr, Strand, SSC, TrStart, TrEnd FROM read_chain) r JOIN model_tr USING (Chr, Strand, SSC) GROUP BY ALL),
read_fixed AS (SELECT sample, read_chain.Chr, read_chain.Strand, read_chain.SSC, CASE WHEN x.d <= 100 THEN x.s ELSE read_chain.TrStart END AS TrStart, CASE WHEN x.d <= 100 THEN x.e ELSE read_chain.TrEnd END AS TrEnd, polyA_len FROM read_chain
LEFT JOIN near_ends ON near_ends.Chr = read_chain.Chr AND near_ends.Strand = read_chain.Strand AND near_ends.SSC = read_chain.SSC AND near_ends.TrStart = read_chain.TrStart AND near_ends.TrEnd = read_chain.TrEnd),
tc AS (SELECT sample, TrID, GeneID, count(*) AS n FROM read_fixed JOIN model_tr USING (Chr, Strand, SSC, TrStart, TrEnd) GROUP BY ALL),
gc AS (SELECT sample, GeneID, CAST(sum(n) AS BIGINT) AS n FROM tc GROUP BY ALL)
"""


#: Alignments made of line items, an order's under one read name; runs in Spark and DuckDB alike.
ALIGNED = """SELECT CAST(l_orderkey AS STRING) AS read_id, concat('s', CAST(l_orderkey % 3 AS STRING)) AS sample,
  CASE WHEN l_suppkey % 2 = 0 THEN 16 ELSE 0 END + CASE WHEN l_orderkey % 17 = 0 THEN 4 ELSE 0 END + CASE WHEN l_linenumber = 3 THEN 256 ELSE 0 END AS flag,
  concat('chr', CAST(l_suppkey % 5 + 1 AS STRING)) AS Chr, pos, clip, m1, ins, del, gap, m2,
  concat(CASE WHEN clip > 0 THEN concat(CAST(clip AS STRING), 'S') ELSE '' END, CAST(m1 AS STRING), 'M', CASE WHEN ins > 0 THEN concat(CAST(ins AS STRING), 'I') ELSE '' END,
         CASE WHEN del > 0 THEN concat(CAST(del AS STRING), 'D') ELSE '' END, CASE WHEN gap > 0 THEN concat(CAST(gap AS STRING), 'N') ELSE '' END, CAST(m2 AS STRING), 'M') AS cigar,
  CASE WHEN l_partkey % 23 = 0 THEN '*' ELSE repeat('A', CAST(clip + m1 + ins + m2 AS INT)) END AS seq,
  CASE WHEN l_partkey % 11 = 0 THEN '-' END AS xs, CASE WHEN l_partkey % 3 = 0 THEN '+' WHEN l_partkey % 3 = 1 THEN '-' END AS ts,
  CASE WHEN l_partkey % 9 > 0 THEN l_partkey % 12 END AS nm, CASE WHEN l_suppkey % 4 > 0 THEN l_suppkey % 50 - 10 END AS pt
FROM (SELECT *, CAST(1 + l_suppkey * 37 % 9000 AS BIGINT) AS pos, CAST(l_quantity AS BIGINT) % 20 AS clip, CAST(20 + l_partkey % 5 AS BIGINT) AS m1, CAST(l_suppkey % 3 AS BIGINT) AS ins, CAST(l_linenumber % 3 AS BIGINT) AS del,
  CASE WHEN l_linenumber % 4 > 0 THEN CAST(60 + l_partkey % 7 AS BIGINT) ELSE 0 END AS gap, CAST(30 + l_suppkey % 4 AS BIGINT) AS m2 FROM {lineitem}) b"""

#: The read rows of ALIGNED, by its own numbers.
ALIGNED_READS = "al AS (" + ALIGNED.replace("{lineitem}", "lineitem") + """),
ar AS (SELECT sample, concat(read_id, '.m', CAST(row_number() OVER (PARTITION BY sample, read_id ORDER BY Chr, pos, cigar, flag, SSC NULLS FIRST, identity, polyA_len) AS VARCHAR)) AS read_id, Chr, Strand, TrStart, TrEnd, SSC, identity, coverage, polyA_len, has_tail FROM (
SELECT *, coalesce(xs, CASE WHEN ts IS NOT NULL THEN CASE WHEN flag & 16 > 0 THEN translate(ts, '+-', '-+') ELSE ts END END, CASE WHEN flag & 16 > 0 THEN '-' ELSE '+' END) AS Strand,
pos AS TrStart, pos + m1 + del + gap + m2 - 1 AS TrEnd, CASE WHEN gap > 0 THEN concat(CAST(pos + m1 + del - 1 AS VARCHAR), '-', CAST(pos + m1 + del + gap AS VARCHAR)) END AS SSC,
CASE WHEN nm IS NULL THEN 1 ELSE 1 - nm / (m1 + ins + m2) END AS identity, (m1 + ins + m2) / (clip + m1 + ins + m2) AS coverage, CAST(greatest(coalesce(pt, 0), 0) AS INT) AS polyA_len, pt IS NOT NULL AS has_tail
FROM al WHERE flag & 4 = 0 AND seq <> '*'))"""


def query(sql: str | None = None, with_: str = ""):
    """Registers f(spark, sf_dir), with its SQL; with_ has more tables for it."""

    def add(f):
        @wraps(f)
        def run(spark, sf):
            token = _TABLES.set({})
            try:
                return f(spark, sf)
            finally:
                _TABLES.reset(token)

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = BASE + (", " + with_ + "\n" if with_ else "") + sql if "SELECT" in sql and not sql.startswith("SELECT /*plain*/") else sql
        return f

    return add


#: Tables that the query being built has written so far.
_TABLES: ContextVar[dict | None] = ContextVar("tables", default=None)


def stage(f):
    """A table of f(spark, sf_dir), written once in a query however often the query uses it."""

    @wraps(f)
    def run(spark, sf):
        held = _TABLES.get()
        if held is None:
            return f(spark, sf)
        if f.__name__ not in held:
            held[f.__name__] = Staged(spark, "isoforms").write(f(spark, sf), f.__name__)
        return held[f.__name__]

    return run


def good(spark: SparkSession, sf: str) -> DataFrame:
    return C.good_reads(tables.reads(spark, sf))


@stage
def placed_reads(spark: SparkSession, sf: str) -> DataFrame:
    """Spliced reads counted by sample, chain and ends: all that later stages read of them."""
    tails = F.count_if(F.col("polyA_len") > 0)
    return good(spark, sf).where("SSC is not null").groupBy("sample", *Q.ENDS).agg(F.count("*").alias("n"), tails.alias("n_tails"))


@stage
def paired_reads(spark: SparkSession, sf: str) -> DataFrame:
    """Spliced reads of all samples counted by chain and ends; a chain's rows lie in one file, so that what is
    counted by chain is small before it is shuffled."""
    tails = F.count_if(F.col("polyA_len") > 0)
    return good(spark, sf).where("SSC is not null").groupBy(*Q.ENDS).agg(F.count("*").alias("n"), tails.alias("n_tails")).hint("rebalance", *C.KEY)


@stage
def collapsed(spark: SparkSession, sf: str) -> DataFrame:
    held = _TABLES.get() or ()
    if "paired_reads" in held or "placed_reads" in held:
        counted_reads = paired_reads if "paired_reads" in held else placed_reads
        return counted_reads(spark, sf).groupBy(*C.KEY).agg(F.sum("n").alias("frequency"), F.min("TrStart").alias("lo"), F.max("TrEnd").alias("hi"))
    return C.collapse(good(spark, sf))


@stage
def located(spark: SparkSession, sf: str) -> DataFrame:
    return C.loci(collapsed(spark, sf))


def with_motifs(spark: SparkSession, sf: str) -> DataFrame:
    g = located(spark, sf)
    one = F.when(F.col("frequency") % 3 == 0, "ct-ac").when(F.col("frequency") % 2 == 0, "gc-ag").otherwise("GT-AG")
    n = F.floor(F.size(F.split("SSC", "-")) / 2).cast("int")
    motifs = g.where("frequency % 11 <> 0").select(*C.KEY, F.array_join(F.array_repeat(one, n), ",").alias("junction"))
    return C.attach_motifs(g, motifs)


def reference(spark: SparkSession, sf: str) -> DataFrame:
    return located(spark, sf).where((F.col("frequency") >= 20) & (F.col("Group") % 2 == 0) & (F.size(F.split("SSC", "-")) >= 4))


def known_chains(spark: SparkSession, sf: str) -> DataFrame:
    return H.mark_known(located(spark, sf), reference(spark, sf))


def model(spark: SparkSession, sf: str) -> DataFrame:
    gene = F.concat(F.lit("G"), F.col("Group").cast("string"))
    return located(spark, sf).where("frequency >= 20").withColumns({"GeneID": gene, "TrID": F.concat(gene, F.lit("_"), "SSC"), "TrStart": F.col("lo"), "TrEnd": F.col("hi")})


@stage
def transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """Model chains with up to two pairs of ends each."""
    far = F.when(F.col("TrEnd") % 4000 >= 1500, "_far").otherwise("")
    ends = placed_reads(spark, sf).groupBy(*C.KEY, far.alias("far")).agg(F.min("TrStart").alias("TrStart"), F.max("TrEnd").alias("TrEnd"))
    return ends.join(model(spark, sf).select(*C.KEY, "GeneID", "TrID"), C.KEY).select(*C.KEY, "TrStart", "TrEnd", F.concat("TrID", "far").alias("TrID"), "GeneID")


def corrected(spark: SparkSession, sf: str) -> DataFrame:
    reads, model_ends = placed_reads(spark, sf), transcripts(spark, sf)
    return T.correct_reads(reads, model_ends, chains=collapsed(spark, sf))


def contigs(spark: SparkSession) -> DataFrame:
    """A sequence for each contig of the reads: repeats of its own."""
    repeats = F.concat(F.expr("repeat('GAT', cast(id as int))"), F.lit("TACACCTG"))
    return spark.range(1, 6).select(F.concat(F.lit("chr"), F.col("id").cast("string")).alias("contig"), F.repeat(repeats, 100_000).alias("seq"))


@stage
def counted(spark: SparkSession, sf: str) -> DataFrame:
    return Q.transcript_counts(corrected(spark, sf), transcripts(spark, sf), "n")


G = '"Group"'


@query("SELECT sample, count(*) AS n, CAST(sum(TrEnd - TrStart) AS BIGINT) AS bases FROM q GROUP BY sample")
def read_quality_filter(spark, sf):
    return good(spark, sf).groupBy("sample").agg(F.count("*").alias("n"), F.sum(F.col("TrEnd") - F.col("TrStart")).alias("bases"))


@query("SELECT * FROM c")
def ssc_collapse(spark, sf):
    return C.collapse(good(spark, sf))


@query("SELECT * FROM c WHERE frequency >= 5")
def ssc_min_support(spark, sf):
    return C.supported(collapsed(spark, sf))


@query("""SELECT Chr, Strand, "Group", site, min(c) AS component FROM reached GROUP BY ALL""", with_="""ed AS (SELECT DISTINCT Chr, Strand, grp AS "Group", t[i] AS u, t[i+1] AS v FROM (SELECT *, unnest(range(1, len(t))) AS i FROM g WHERE frequency >= 5)),
both_ways AS (SELECT * FROM ed UNION SELECT Chr, Strand, "Group", v, u FROM ed),
reached AS (SELECT Chr, Strand, "Group", u AS site, u AS c FROM both_ways UNION SELECT r.Chr, r.Strand, r."Group", b.v, r.c FROM reached r JOIN both_ways b ON b.Chr = r.Chr AND b.Strand = r.Strand AND b."Group" = r."Group" AND b.u = r.site WHERE r.c < b.v)""")
def splice_components(spark, sf):
    """Loci of all chains fall apart into splice graphs of the supported ones."""
    pairs = chain.windows(chain.sites(F.col("SSC")), 2)
    edges = C.supported(located(spark, sf)).select(*C.LOCUS, F.explode(pairs).alias("p")).select(*C.LOCUS, F.col("p")[0].alias("u"), F.col("p")[1].alias("v"))
    return graphs.components(edges, by=C.LOCUS).select(*C.LOCUS, F.col("node").alias("site"), "component")


@query('SELECT Chr, Strand, SSC, frequency, grp AS "Group" FROM g')
def gene_grouping(spark, sf):
    return located(spark, sf).select(*C.KEY, "frequency", "Group")


@query("SELECT Chr, Strand, SSC, junction FROM mo")
def junction_attach(spark, sf):
    return with_motifs(spark, sf).select(*C.KEY, "junction")


@query("""SELECT Chr, Strand, SSC, junction, frequency FROM (SELECT *, frequency / sum(frequency) OVER (PARTITION BY grp) AS share FROM mo)
WHERE share > 0.25 OR len(list_filter(string_split(upper(junction), ','), lambda m: m NOT IN ('GT-AG', 'AT-AC', 'GC-AG'))) = 0""")
def junction_screening(spark, sf):
    return C.screen_motifs(with_motifs(spark, sf)).select(*C.KEY, "junction", "frequency")


@query("""SELECT Chr, Strand, SSC FROM mo JOIN (SELECT Chr, Strand, SSC, avg(TrStart) AS a, avg(TrEnd) AS b FROM q GROUP BY ALL) USING (Chr, Strand, SSC), (SELECT avg(frequency) AS m FROM mo) WHERE frequency >= 0.3 * m
OR NOT ((len(t) = 2 AND least(abs(t[1] - a), abs(b - t[-1])) < 201) OR len(list_filter(string_split(junction, ','), lambda m: m NOT IN ('GT-AG', 'AT-AC', 'GC-AG'))) > 0)""")
def fragment_filter(spark, sf):
    return C.drop_fragments(with_motifs(spark, sf).join(C.mean_ends(good(spark, sf)), C.KEY), least_exon=201, rare=0.3).select(*C.KEY)


@query("""SELECT Chr, Strand, SSC FROM g WHERE grp IN (SELECT grp FROM g LEFT JOIN (SELECT DISTINCT Chr, Strand, SSC, true AS known FROM ref) USING (Chr, Strand, SSC) GROUP BY grp
HAVING sum(frequency) >= (SELECT quantile_cont(frequency, 0.9) FROM g) OR bool_or(coalesce(known, false)))""")
def group_quantile_filter(spark, sf):
    return C.keep_loci(located(spark, sf), reference(spark, sf), 0.9).select(*C.KEY)


@query(f"SELECT Chr, Strand, grp AS {G}, u, v, round(weight, 6) AS weight FROM ew")
def edge_weights(spark, sf):
    return C.edge_weights(located(spark, sf)).withColumn("weight", F.round("weight", 6))


@query(f"""SELECT Chr, Strand, grp AS {G}, site, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree FROM
(SELECT Chr, Strand, grp, u AS site, 1 AS o, 0 AS i FROM ew UNION ALL SELECT Chr, Strand, grp, v, 0, 1 FROM ew) GROUP BY ALL""")
def edge_degrees(spark, sf):
    return C.degrees(C.edge_weights(located(spark, sf)))


@query()
def weak_edge_fixpoint(spark, sf):
    _checkpoints(spark)
    return C.drop_weak_edges(located(spark, sf), 0.2, 50).select(*C.KEY)


@query(f"SELECT Chr, Strand, SSC, grp AS {G}, array_to_string(ext, '-') AS ext FROM ex")
def chain_extension(spark, sf):
    return C.extend(located(spark, sf)).select(*C.KEY, "Group", chain.joined(F.col("ext")).alias("ext"))


ERR = """SELECT DISTINCT Chr, Strand, grp, CASE WHEN f <= f2 THEN site ELSE s2 END AS site FROM
(SELECT *, lead(site) OVER w AS s2, lead(f) OVER w AS f2 FROM sf WINDOW w AS (PARTITION BY grp ORDER BY site)) WHERE s2 - site <= 10 AND least(f, f2) / greatest(f, f2) <= 0.2"""


@query(f'SELECT Chr, Strand, SSC FROM g WHERE NOT EXISTS (SELECT 1 FROM ({ERR}) x WHERE x.grp = g.grp AND list_contains(g.t, x.site))')
def error_sites(spark, sf):
    g = located(spark, sf)
    return C.drop_sites(g, C.error_sites(g, ratio=0.2)).select(*C.KEY)


@query(f"""SELECT DISTINCT w4.Chr, w4.Strand, w4.grp AS {G}, array_to_string(CASE WHEN w4.f < w2.f THEN w4.p ELSE w2.p END, '-') AS fragment FROM w4 JOIN w2
ON w4.grp = w2.grp AND w4.p[1] = w2.p[1] AND w4.p[4] = w2.p[2] WHERE w4.p[3] - w4.p[2] <= 30 AND least(w4.f, w2.f) / greatest(w4.f, w2.f) < 0.5""")
def little_exon_jump(spark, sf):
    return C.jump_errors(located(spark, sf), ratio=0.5).withColumn("fragment", chain.joined(F.col("fragment")))


@query(f"""SELECT DISTINCT a.Chr, a.Strand, a.grp AS {G}, array_to_string(CASE WHEN a.f < b.f THEN a.p ELSE b.p END, '-') AS fragment FROM w6 a JOIN w4 b
ON a.grp = b.grp AND a.p[1] = b.p[1] AND a.p[6] = b.p[4] WHERE least(a.p[3] - a.p[2], a.p[5] - a.p[4]) <= 30
AND abs(a.p[3] - a.p[2] + a.p[5] - a.p[4] - b.p[3] + b.p[2]) <= 1000 AND least(a.f, b.f) / greatest(a.f, b.f) < 0.5""")
def little_exon_misalign(spark, sf):
    return C.misaligned_errors(located(spark, sf), apart=1000, ratio=0.5).withColumn("fragment", chain.joined(F.col("fragment")))


FORK = """de AS (SELECT DISTINCT grp, ext[i] AS u, ext[i+1] AS v FROM (SELECT *, unnest(range(1, len(ext))) AS i FROM ex)),
fo AS (SELECT grp, u FROM de GROUP BY ALL HAVING count(*) > 1), me AS (SELECT grp, v FROM de GROUP BY ALL HAVING count(*) > 1),
f4 AS (SELECT * FROM w4 WHERE (grp, p[1]) IN (SELECT (grp, u) FROM fo) AND (grp, p[4]) IN (SELECT (grp, v) FROM me))"""


@query(f""", {FORK} SELECT DISTINCT a.Chr, a.Strand, a.grp AS {G}, array_to_string(a.p, '-') AS fragment FROM f4 a JOIN f4 b
ON a.grp = b.grp AND a.p[1] = b.p[1] AND a.p[4] = b.p[4] AND a.p <> b.p WHERE a.f / b.f < 0.5 AND abs((a.p[3] - a.p[2]) - (b.p[3] - b.p[2])) <= 20""")
def fork_paths(spark, sf):
    return C.fork_errors(located(spark, sf), ratio=0.5).withColumn("fragment", chain.joined(F.col("fragment")))


@query("""SELECT Chr, Strand, SSC FROM ex g WHERE NOT EXISTS (SELECT 1 FROM (SELECT w4.grp, CASE WHEN w4.f < w2.f THEN w4.p ELSE w2.p END AS fr FROM w4 JOIN w2
ON w4.grp = w2.grp AND w4.p[1] = w2.p[1] AND w4.p[4] = w2.p[2] WHERE w4.p[3] - w4.p[2] <= 30 AND least(w4.f, w2.f) / greatest(w4.f, w2.f) < 0.5) x
WHERE x.grp = g.grp AND len(list_filter(range(1, len(g.ext) - len(x.fr) + 2), lambda i: g.ext[i : i + len(x.fr) - 1] = x.fr)) > 0)""")
def fragment_removal(spark, sf):
    g = located(spark, sf)
    return C.drop_fragments_of(g, C.jump_errors(g, ratio=0.5)).select(*C.KEY)


GUIDED = """kn AS (SELECT ex.*, bool_or(known) OVER (PARTITION BY grp) AS guided FROM (SELECT ex.*, frequency >= 20 AND grp % 2 = 0 AND len(t) >= 4 AS known FROM ex) ex),
ks AS (SELECT Chr, Strand, grp, site, sum(frequency) AS f, bool_or(known) AS known, bool_or(guided) AS guided FROM (SELECT *, unnest(t) AS site FROM kn) GROUP BY ALL),
kw AS (SELECT kn.*, k, ext[i:i + k - 1] AS p, i FROM kn, (SELECT unnest([2, 4, 6]) AS k), LATERAL (SELECT unnest(range(1, len(ext) - k + 2)) AS i))"""


@query(f"""SELECT Chr, Strand, grp AS {G}, CASE WHEN f <= f2 THEN site ELSE s2 END AS site FROM (SELECT *, lead(site) OVER w AS s2, lead(f) OVER w AS f2, lead(known) OVER w AS k2 FROM ks WINDOW w AS (PARTITION BY grp ORDER BY site))
WHERE s2 - site <= 10 AND least(f, f2) / greatest(f, f2) <= CASE WHEN guided THEN 0.3 ELSE 0.2 END AND NOT CASE WHEN f <= f2 THEN known ELSE k2 END GROUP BY ALL""", with_=GUIDED)
def guided_error_sites(spark, sf):
    return H.error_sites(known_chains(spark, sf), ratio=0.2, ratio_ref=0.3)


@query(f"""SELECT DISTINCT Chr, Strand, grp AS {G}, array_to_string(CASE WHEN n >= j THEN [a, d] ELSE rarest END, '-') AS fragment FROM (SELECT Chr, Strand, grp, p[1] AS a, p[4] AS d, sum(frequency) AS n, bool_or(known) AS known, bool_or(guided) AS guided, min({{'f': frequency, 'p': p}}).p AS rarest
FROM kw WHERE k = 4 AND i % 2 = 0 AND p[3] - p[2] <= 30 GROUP BY Chr, Strand, grp, p[1], p[4]) x JOIN (SELECT grp, p[1] AS a, p[2] AS d, sum(frequency) AS j FROM kw WHERE k = 2 GROUP BY ALL) y USING (grp, a, d)
WHERE least(n, j) / greatest(n, j) < CASE WHEN guided THEN 0.7 ELSE 0.5 END AND (n >= j OR NOT (guided AND known))""", with_=GUIDED)
def guided_jumps(spark, sf):
    return H.jump_errors(known_chains(spark, sf), ratio=0.5, ratio_ref=0.7).withColumn("fragment", chain.joined(F.col("fragment")))


@query(f"""SELECT DISTINCT Chr, Strand, grp AS {G}, array_to_string(fr, '-') AS fragment FROM (SELECT a.Chr, a.Strand, a.grp, unnest(list_concat(CASE WHEN (a.known OR NOT a.guided) AND b.frequency / a.frequency < CASE WHEN a.guided THEN 0.9 ELSE 0.8 END THEN [b.p[2:3]] ELSE [] END,
CASE WHEN (b.known OR NOT a.guided) AND a.frequency / b.frequency < CASE WHEN a.guided THEN 0.9 ELSE 0.8 END THEN [a.p[2:5]] ELSE [] END)) AS fr FROM kw a JOIN kw b ON a.grp = b.grp AND a.p[1] = b.p[1] AND a.p[6] = b.p[4]
WHERE a.k = 6 AND b.k = 4 AND a.i % 2 = 1 AND a.i + 5 < len(a.ext) AND a.p[4] - a.p[3] <= 30 AND abs(a.p[2] - a.p[1] + a.p[4] - a.p[3] + a.p[6] - a.p[5] - b.p[2] + b.p[1] - b.p[4] + b.p[3]) <= 1000 AND len(list_filter(b.p, lambda x: NOT list_contains(a.p, x))) > 0)""", with_=GUIDED)
def guided_misalign(spark, sf):
    return H.misaligned_errors(known_chains(spark, sf), apart=1000, ratio=0.8, ratio_ref=0.9).withColumn("fragment", chain.joined(F.col("fragment")))


@query()
def guided_graph_filter(spark, sf):
    g = located(spark, sf)
    return H.filter_graph(g, C.supported(g), reference(spark, sf)).select(*C.KEY, "frequency", "category")


@query("""SELECT Chr, Strand, SSC, frequency FROM c WHERE frequency >= 40 OR (Chr, Strand, SSC) IN (SELECT (Chr, Strand, SSC) FROM ref)""")
def fsm_rescue(spark, sf):
    raw = C.collapse(good(spark, sf))
    return C.rescue_known(raw, C.supported(raw, 40), reference(spark, sf)).select(*C.KEY, "frequency")


@query("""SELECT Chr, Strand, SSC, CASE WHEN bool_or(rs = SSC) THEN 'FSM' WHEN len(list_filter(any_value(t), lambda x: NOT coalesce(list_contains(list_distinct(flatten(list(rt))), x), false))) = 0 THEN 'NIC' ELSE 'NNC' END AS category
FROM (SELECT g.*, r.SSC AS rs, r.t AS rt FROM g LEFT JOIN ref r ON g.grp = r.grp) GROUP BY Chr, Strand, SSC""")
def isoform_category(spark, sf):
    return C.categories(located(spark, sf), reference(spark, sf)).select(*C.KEY, "category")


@query(f"SELECT g.Chr, g.Strand, g.grp AS {G}, src.SSC, source, sf AS source_frequency FROM src JOIN g ON g.grp = src.grp AND g.SSC = src.SSC")
def ism_sources(spark, sf):
    return C.sub_chain_sources(located(spark, sf))


@query("""SELECT Chr, Strand, g.SSC, CASE WHEN s IS NULL OR (frequency / (frequency + s) >= 0.5 AND frequency / a >= 0.2) THEN 'no' ELSE 'yes' END AS truncation
FROM (SELECT *, sum(frequency) OVER (PARTITION BY grp) AS a FROM g) g LEFT JOIN (SELECT grp, SSC, sum(sf) AS s FROM src GROUP BY ALL) x ON x.grp = g.grp AND x.SSC = g.SSC""")
def truncation_calls(spark, sf):
    return C.truncation(located(spark, sf), locus_share=0.2).select(*C.KEY, "truncation")


@query("""SELECT Chr, Strand, g.SSC, CASE WHEN s IS NULL OR (frequency / (frequency + s) >= 0.5 AND frequency / a >= 0.5) OR (frequency % 4 > 0 AND frequency % 10 >= 5) THEN 'no' ELSE 'yes' END AS truncation
FROM (SELECT *, sum(frequency) OVER (PARTITION BY grp) AS a FROM g) g LEFT JOIN (SELECT grp, SSC, sum(sf) AS s FROM src GROUP BY ALL) x ON x.grp = g.grp AND x.SSC = g.SSC
WHERE truncation = 'no' OR (Chr, Strand, g.SSC) IN (SELECT (Chr, Strand, SSC) FROM ref)""")
def truncation_filter(spark, sf):
    """Chains with starts of their own or known ones stay; a score that was not found is "no"."""
    score = F.when(F.col("frequency") % 4 == 0, "no").otherwise((F.col("frequency") % 10 / 50).cast("string"))
    called = C.truncation(located(spark, sf).withColumn("tss", score), tss_score="tss")
    return C.drop_truncated(called, reference(spark, sf)).select(*C.KEY, "truncation")


@query("""SELECT Chr, Strand, SSC, frequency, CASE WHEN bool_or(rs = SSC) THEN 'FSM' WHEN len(list_filter(any_value(t), lambda x: NOT coalesce(list_contains(list_distinct(flatten(list(rt))), x), false))) = 0 THEN 'NIC' ELSE 'NNC' END AS category
FROM (SELECT g.*, r.SSC AS rs, r.t AS rt FROM g LEFT JOIN ref r ON g.grp = r.grp WHERE g.frequency >= 5) GROUP BY ALL UNION ALL SELECT Chr, Strand, SSC, frequency, NULL FROM g WHERE frequency < 5""")
def category_attach(spark, sf):
    g = located(spark, sf)
    return C.attach_categories(g, C.categories(C.supported(g), reference(spark, sf))).select(*C.KEY, "frequency", "category")


@query(f"SELECT Chr, Strand, SSC, grp AS {G} FROM g WHERE grp IN (SELECT grp FROM g WHERE frequency < 20 AND grp % 3 > 0)")
def loci_with_data(spark, sf):
    marked = located(spark, sf).withColumn("source", F.when((F.col("frequency") >= 20) | (F.col("Group") % 3 == 0), "ref").otherwise("data"))
    return C.loci_with_data(marked).select(*C.KEY, "Group")


@query(f"""SELECT Chr, Strand, SSC, grp AS {G}, lo AS TrStart, hi AS TrEnd, frequency, NULL AS nmd FROM g WHERE frequency >= 20
UNION ALL SELECT Chr, Strand, NULL, NULL, TrStart, TrEnd, count(*), 'no' FROM q WHERE SSC IS NULL GROUP BY Chr, Strand, TrStart, TrEnd""")
def single_exon_union(spark, sf):
    m = model(spark, sf).select(*C.KEY, "Group", "TrStart", "TrEnd", "frequency", F.lit(None).cast("string").alias("nmd"))
    return C.with_single_exons(m, singles(spark, sf).select("Chr", "Strand", "TrStart", "TrEnd", "frequency"), {"nmd": "no"})


@query("SELECT TrID, array_to_string(list_sort(list_concat([lo, hi], t)), '-') AS sites FROM model")
def sorted_sites(spark, sf):
    return model(spark, sf).select("TrID", chain.joined(chain.all_sites(F.col("TrStart"), chain.sites(F.col("SSC")), F.col("TrEnd"))).alias("sites"))


@query("SELECT Chr, Strand, SSC, TrStart, TrEnd, TrID, GeneID, n FROM (SELECT Chr, Strand, SSC, TrStart, TrEnd, count(*) AS n FROM q WHERE SSC IS NOT NULL GROUP BY ALL) JOIN model_tr USING (Chr, Strand, SSC, TrStart, TrEnd)")
def ids_join(spark, sf):
    ends = placed_reads(spark, sf).groupBy(*Q.ENDS).agg(F.sum("n").alias("n"))
    return P.with_ids(ends, transcripts(spark, sf).withColumn("GeneName", F.col("GeneID"))).select(*Q.ENDS, "TrID", "GeneID", "n")


@query("""SELECT count(*) FILTER (WHERE Chr LIKE 'chr%') > count(*) FILTER (WHERE Chr NOT LIKE 'chr%') AS prefixed, true AS sequences_prefixed, count(*) AS expected, count(*) FILTER (WHERE Chr IN ('chr1', 'chr2', 'chr3')) AS matched FROM (SELECT DISTINCT Chr FROM reads)""")
def contig_shares(spark, sf):
    """Contigs of the reads, of which three have a sequence."""
    some = contigs(spark).where("contig in ('chr1', 'chr2', 'chr3')").select(F.col("contig").alias("Chr"))
    return guards.contig_shares(tables.reads(spark, sf), some)


@query("SELECT sample, TrID, GeneID, CAST(n AS BIGINT) AS count FROM tc WHERE sample <> 's1'")
def quantified_samples(spark, sf):
    """Two samples, and one asked for that has no reads."""
    return Q.quantify(corrected(spark, sf), transcripts(spark, sf), ["s0", "s2", "none"], partial=True, n="n")


@query("SELECT Chr, Strand, SSC, CAST(sum(frequency) AS BIGINT) AS frequency, count(DISTINCT sample) AS samples, min(lo) AS lo, max(hi) AS hi FROM bysample GROUP BY ALL")
def sample_merge(spark, sf):
    return C.merge_samples(C.collapse(good(spark, sf), ("sample",)))


@query("SELECT sample, Chr, Strand, SSC, frequency FROM bysample WHERE (Chr, Strand, SSC) IN (SELECT (Chr, Strand, SSC) FROM bysample WHERE frequency >= 10)")
def low_freq_rescue(spark, sf):
    raw = C.collapse(good(spark, sf), ("sample",))
    kept = C.supported(raw, 10)
    return C.rescue_samples(kept, raw, kept).select("sample", *C.KEY, "frequency")


@query("""SELECT Chr, Strand, SSC, (SELECT TrStart FROM q r WHERE r.Chr = c.Chr AND r.Strand = c.Strand AND r.SSC = c.SSC GROUP BY TrStart ORDER BY count(*) DESC, TrStart LIMIT 1) AS start_mode,
(SELECT TrEnd FROM q r WHERE r.Chr = c.Chr AND r.Strand = c.Strand AND r.SSC = c.SSC GROUP BY TrEnd ORDER BY count(*) DESC, TrEnd DESC LIMIT 1) AS end_mode FROM c""")
def terminal_mode(spark, sf):
    return T.modes(good(spark, sf))


DB = """d AS (SELECT Chr, Strand, SSC, TrEnd AS v, count(*) AS n FROM q WHERE SSC IS NOT NULL GROUP BY ALL),
dn AS (SELECT *, sum(n) OVER (PARTITION BY Chr, Strand, SSC) AS a, sum(n) OVER (PARTITION BY Chr, Strand, SSC ORDER BY v RANGE BETWEEN 15 PRECEDING AND 15 FOLLOWING) AS nb FROM d),
dc AS (SELECT *, v - lag(v) OVER (PARTITION BY Chr, Strand, SSC ORDER BY v) > 15 AS nw FROM dn WHERE nb >= greatest(floor(0.1 * a), 5)),
co AS (SELECT Chr, Strand, SSC, v, sum(CASE WHEN nw THEN 1 ELSE 0 END) OVER (PARTITION BY Chr, Strand, SSC ORDER BY v) AS cl FROM dc),
bo AS (SELECT d.Chr, d.Strand, d.SSC, d.v, d.n, (SELECT cl FROM co WHERE co.Chr = d.Chr AND co.Strand = d.Strand AND co.SSC = d.SSC AND abs(co.v - d.v) <= 15 ORDER BY abs(co.v - d.v), co.v LIMIT 1) AS cl FROM d)"""


@query(f", {DB} SELECT Chr, Strand, SSC, CAST(cl AS BIGINT) AS cluster, CAST(sum(n) AS BIGINT) AS n, min(v) AS lo, max(v) AS hi FROM bo GROUP BY ALL")
def dbscan_termini(spark, sf):
    v = good(spark, sf).where("SSC is not null").select(*C.KEY, "TrEnd")
    return T.clusters(v, C.KEY, "TrEnd", least=5).groupBy(*C.KEY, "cluster").agg(F.count("*").alias("n"), F.min("TrEnd").alias("lo"), F.max("TrEnd").alias("hi"))


@query()
def terminal_pairs(spark, sf):
    return T.terminal_pairs(placed_reads(spark, sf), "n")


@query("""SELECT Chr, Strand, SSC, x.s AS model_SSC, round(x.d, 6) AS distance FROM (SELECT c.Chr, c.Strand, c.SSC, min({'d': list_distance(CAST(st.t AS DOUBLE[]), CAST(m.t AS DOUBLE[])), 's': m.SSC}) AS x
FROM c JOIN st USING (Chr, Strand, SSC) JOIN model m ON m.Chr = c.Chr AND m.Strand = c.Strand AND len(m.t) = len(st.t) WHERE list_distance(CAST(st.t AS DOUBLE[]), CAST(m.t AS DOUBLE[])) <= 15 GROUP BY ALL)""")
def nearest_chain(spark, sf):
    return T.nearest_chains(good(spark, sf), model(spark, sf)).withColumn("distance", F.round("distance", 6))


@query("""SELECT r.*, CASE WHEN sqrt((TrStart - lo)**2 + (TrEnd - hi)**2) <= 50 THEN lo END AS model_start, CASE WHEN sqrt((TrStart - lo)**2 + (TrEnd - hi)**2) <= 50 THEN hi END AS model_end
FROM (SELECT Chr, Strand, SSC, TrStart, TrEnd, count(*) AS n FROM q WHERE SSC IS NOT NULL GROUP BY ALL) r JOIN (SELECT Chr, Strand, SSC, lo, hi FROM model) m USING (Chr, Strand, SSC)""")
def nearest_terminal(spark, sf):
    return T.nearest_ends(good(spark, sf), model(spark, sf).select(*C.KEY, "TrStart", "TrEnd"))


@query("SELECT sample, Chr, Strand, SSC, TrStart, TrEnd, count(*) AS n FROM read_fixed GROUP BY ALL")
def read_correction(spark, sf):
    return corrected(spark, sf).groupBy("sample", *Q.ENDS).agg(F.sum("n").alias("n"))


# some transcripts further on, which no read has
PF = """SELECT TrID, coalesce(v, 0) AS polyA_valid_reads, round(v / n, 6) AS polyA_frac FROM (SELECT * FROM model_tr UNION ALL SELECT Chr, Strand, SSC, GeneID, concat(TrID, '_later'), TrStart + 1000, TrEnd + 1000 FROM model_tr WHERE TrStart % 2 = 0)
LEFT JOIN (SELECT Chr, Strand, SSC, TrStart, TrEnd, count(*) FILTER (WHERE polyA_len > 0) AS v, count(*) AS n FROM read_fixed GROUP BY ALL) USING (Chr, Strand, SSC, TrStart, TrEnd)"""


def tails(spark, sf):
    t = transcripts(spark, sf)
    later = t.where("TrStart % 2 = 0").withColumns({"TrID": F.concat("TrID", F.lit("_later")), "TrStart": F.col("TrStart") + 1000, "TrEnd": F.col("TrEnd") + 1000})
    return T.polya_fraction(corrected(spark, sf), t.unionByName(later), "n", "n_tails").select("TrID", "polyA_valid_reads", F.round("polyA_frac", 6).alias("polyA_frac"))


@query(PF)
def polya_fraction(spark, sf):
    return tails(spark, sf)


@query(f"SELECT CASE WHEN polyA_frac IS NULL THEN 'missing' WHEN polyA_frac > 0.9 THEN 'positive' ELSE 'measured' END AS state, count(*) AS n FROM ({PF}) GROUP BY ALL")
def polya_state(spark, sf):
    state = F.when(F.col("polyA_frac").isNull(), "missing").when(F.col("polyA_frac") > 0.9, "positive").otherwise("measured")
    return tails(spark, sf).groupBy(state.alias("state")).agg(F.count("*").alias("n"))


@query("SELECT Chr, Strand, SSC, round(median(polyA_len), 1) AS polyA_median, round(avg(polyA_len), 1) AS polyA_mean, count(*) AS polyA_count FROM q WHERE polyA_len > 0 AND SSC IS NOT NULL GROUP BY ALL")
def polya_len_tx(spark, sf):
    return T.polya_lengths(good(spark, sf).where("SSC is not null"), C.KEY)


@query("SELECT GeneID, round(median(polyA_len), 1) AS polyA_median, round(avg(polyA_len), 1) AS polyA_mean, count(*) AS polyA_count FROM q JOIN model USING (Chr, Strand, SSC) WHERE polyA_len > 0 GROUP BY ALL")
def polya_len_gene(spark, sf):
    return T.polya_lengths(good(spark, sf).join(model(spark, sf).select(*C.KEY, "GeneID"), C.KEY), ["GeneID"])


@query("""SELECT GeneID, round(median(polyA_len), 1) AS polyA_median, round(avg(polyA_len), 1) AS polyA_mean, count(*) AS polyA_count,
(SELECT string_agg(concat(l, ':', n), ',' ORDER BY l) FROM (SELECT unnest(map_keys(h)) AS l, unnest(map_values(h)) AS n FROM (SELECT histogram(polyA_len) AS h))) AS lengths FROM q JOIN model USING (Chr, Strand, SSC) WHERE polyA_len > 0 GROUP BY ALL""")
def polya_profile_gene(spark, sf):
    p = T.polya_profiles(good(spark, sf).join(model(spark, sf).select(*C.KEY, "GeneID"), C.KEY), ["GeneID"])
    return p.withColumn("lengths", F.array_join(F.transform("lengths", lambda x: F.concat_ws(":", x["length"], x["n"])), ","))


SE = "(SELECT Chr, Strand, TrStart, TrEnd, count(*) AS frequency, count(*) FILTER (WHERE polyA_len > 0) AS v, count(*) AS n FROM q WHERE SSC IS NULL GROUP BY ALL)"
SO = f"""SELECT s.*, NOT EXISTS (SELECT 1 FROM model m WHERE m.Chr = s.Chr AND m.Strand = s.Strand AND m.grp % 3 = 0 AND s.TrStart <= m.hi AND m.lo <= s.TrEnd) AS free FROM {SE} s"""


def singles(spark, sf):
    r = good(spark, sf).where("SSC is null").groupBy("Chr", "Strand", "TrStart", "TrEnd").agg(F.count("*").alias("frequency"), F.count_if(F.col("polyA_len") > 0).alias("polyA_valid_reads"))
    return T.single_exon_overlaps(r, model(spark, sf).where(F.col("Group") % 3 == 0))


@query(f"SELECT Chr, Strand, TrStart, TrEnd, frequency, free AS is_intergenic_or_antisense FROM ({SO})")
def single_exon_overlap(spark, sf):
    return singles(spark, sf).select("Chr", "Strand", "TrStart", "TrEnd", "frequency", "is_intergenic_or_antisense")


@query(f"""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN NOT free THEN 'P1_genic_overlap' WHEN frequency < 15 THEN 'P4_low_freq' WHEN TrEnd - TrStart + 1 < 200 THEN 'P5_short'
WHEN TrStart % 7 / 10.0 < 0.1 THEN 'P2_weak_tss' WHEN NOT (v / frequency >= 0.9 AND v >= 3) THEN 'P3_polya_fail' ELSE 'PASS' END AS reason FROM ({SO})) GROUP BY ALL""")
def single_exon_funnel(spark, sf):
    s = singles(spark, sf).withColumns({"tss_score": F.col("TrStart") % 7 / 10.0, "polyA_frac": F.col("polyA_valid_reads") / F.col("frequency"), "primed_inside": F.lit(True)})
    return T.single_exon_reasons(s, polya=0.9).groupBy("reason").agg(F.count("*").alias("n"))


DNA = "translate(upper({x}), 'EOIUSHRLDTN', 'AAAAGGCCTTN')"


@query("""SELECT doc_id, coalesce(length(w) < 10 OR contains(w, 'AAAAAA') OR (length(w) - length(replace(w, 'A', ''))) / length(w) >= 0.6, true) AS primed
FROM (SELECT doc_id, translate(upper(substr(text, 101, 20)), 'EOIUSHRLDTN', 'AAAAGGCCTTN') AS w FROM documents)""")
def intra_priming(spark, sf):
    # letter by letter, as the SQL has it: Spark's upper() makes SS of one ß; only ı and ſ become A-Z besides
    up = F.translate(F.substring("text", 101, 20), chain.LOWER + "ıſ", chain.LOWER.upper() + "IS")
    w = F.translate(up, "EOIUSHRLDTN", "AAAAGGCCTTN")
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", chain.primed_inside(w).alias("primed"))


@query("SELECT doc_id, md5(reverse(translate(text, 'ACGTRYKMBVDHSWNacgtrykmbvdhswn', 'TGCAYRMKVBHDSWNtgcayrmkvbhdswn'))) AS iupac, md5(reverse(translate(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), 'ACGT', 'TGCA'))) AS plain FROM documents")
def reverse_complement(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select("doc_id", F.md5(chain.reverse_complement(F.col("text")).cast("binary")).alias("iupac"), F.md5(chain.reverse_complement(F.col("text"), plain=True).cast("binary")).alias("plain"))


def aligned(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return A.to_reads(spark.sql(ALIGNED, lineitem=li), "sample")


@query("SELECT sample, read_id, Chr, Strand, TrStart, TrEnd, SSC, round(identity, 9) AS identity, round(coverage, 9) AS coverage, polyA_len, has_tail FROM ar", with_=ALIGNED_READS)
def alignment_reads(spark, sf):
    return aligned(spark, sf).withColumns({c: F.round(c, 9) for c in ("identity", "coverage")})


@query("SELECT sample, bool_or(has_tail) AS has_polya FROM ar GROUP BY sample", with_=ALIGNED_READS)
def library_tails(spark, sf):
    return A.has_tails(aligned(spark, sf), ("sample",))


@query("""SELECT CAST(count(*) AS BIGINT) AS count, Chr, Strand, SSC, CASE WHEN Strand = '-' THEN concat(reverse(translate(r, 'ACGT', 'TGCA')), '-', reverse(translate(l, 'ACGT', 'TGCA'))) ELSE concat(l, '-', r) END AS junction
FROM (SELECT Chr, Strand, SSC, substr(seq, CAST(split_part(SSC, '-', 1) AS BIGINT) + 1, 2) AS l, substr(seq, CAST(split_part(SSC, '-', 2) AS BIGINT) - 2, 2) AS r
FROM ar JOIN (SELECT concat('chr', CAST(i AS VARCHAR)) AS Chr, repeat(concat(repeat('GAT', i), 'TACACCTG'), 1000) AS seq FROM range(1, 6) r(i)) USING (Chr) WHERE SSC IS NOT NULL) GROUP BY ALL""", with_=ALIGNED_READS)
def junction_motifs(spark, sf):
    return A.junction_counts(aligned(spark, sf), U.genome_bins(contigs(spark)))


@query("""SELECT x AS cigar, CAST(count(*) AS BIGINT) AS n, any_value(concat('0:', CAST(a + d AS VARCHAR), ',', CAST(a + d + 500 AS VARCHAR), ':', CAST(a + d + 500 + p AS VARCHAR))) AS exons,
any_value(a + i + p) AS covered, any_value(CAST(3 AS BIGINT)) AS clipped FROM (SELECT concat('3S', CAST(a AS VARCHAR), 'M', CAST(d AS VARCHAR), 'D500N', CAST(i AS VARCHAR), 'I', CAST(p AS VARCHAR), 'M') AS x, * FROM
(SELECT CAST(l_quantity AS BIGINT) AS a, CAST(l_linenumber AS BIGINT) AS d, CAST(l_linenumber % 3 + 1 AS BIGINT) AS i, CAST(l_suppkey % 40 + 1 AS BIGINT) AS p FROM lineitem)) GROUP BY x""")
def cigar_blocks(spark, sf):
    s = lambda c: F.expr(f"cast(cast({c} as bigint) as string)")
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.concat(F.lit("3S"), s("l_quantity"), F.lit("M"), s("l_linenumber"), F.lit("D500N"), s("l_linenumber % 3 + 1"), F.lit("I"), s("l_suppkey % 40 + 1"), F.lit("M")).alias("cigar"))
    p = li.groupBy("cigar").agg(F.count("*").alias("n")).withColumn("p", chain.cigar(F.col("cigar")))
    text = F.array_join(F.transform("p.exons", lambda e: F.concat(e["s"].cast("string"), F.lit(":"), e["e"].cast("string"))), ",")
    return p.select("cigar", "n", text.alias("exons"), "p.covered", "p.clipped")


EXL = "list_transform(range(0, len(t) // 2 + 1), lambda i: list_concat([lo], t, [hi])[2*i+1 : 2*i+2])"


@query(f"""SELECT TrID, array_to_string(list_transform({EXL}, lambda x: concat(CAST(x[1] AS VARCHAR), ':', CAST(x[2] AS VARCHAR))), ',') AS exons,
array_to_string(list_transform(range(0, len(t) // 2), lambda i: concat(CAST(t[2*i+1] AS VARCHAR), ':', CAST(t[2*i+2] AS VARCHAR))), ',') AS introns,
CAST(list_sum(list_transform({EXL}, lambda x: x[2] - x[1] + 1)) AS BIGINT) AS length FROM model""")
def exon_intron_lists(spark, sf):
    pair = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))), ",")
    s = chain.sites(F.col("SSC"))
    ex = chain.exons(F.col("TrStart"), s, F.col("TrEnd"))
    return model(spark, sf).select("TrID", pair(ex).alias("exons"), pair(chain.introns(s)).alias("introns"), chain.total(chain.exon_lengths(ex)).alias("length"))


@query(f"""SELECT TrID, CASE WHEN frequency % 5 = 0 THEN 'no_orf' WHEN (len(t) > 1 AND tts <= n - last - 55) OR n - tts > 1000 THEN 'NMD' ELSE 'Normal' END AS nmd FROM
(SELECT *, CAST(list_sum(l) AS BIGINT) AS n, CASE WHEN Strand = '-' THEN l[1] ELSE l[-1] END AS last, (frequency * 37) % CAST(list_sum(l) AS BIGINT) AS tts FROM (SELECT *, list_transform({EXL}, lambda x: x[2] - x[1] + 1) AS l FROM model))""")
def nmd_call(spark, sf):
    m = model(spark, sf).withColumn("x", chain.exons(F.col("TrStart"), chain.sites(F.col("SSC")), F.col("TrEnd")))
    m = m.withColumns({"tts": F.col("frequency") * 37 % chain.total(chain.exon_lengths(F.col("x"))), "p": F.when(F.col("frequency") % 5 == 0, 0.5).otherwise(0.95)})
    return m.select("TrID", chain.nmd(F.col("x"), F.col("Strand"), F.col("p"), F.lit(0.99), F.col("tts")).alias("nmd"))


@query(f"""SELECT TrID, CAST(sum(greatest(0, least(b, e) - greatest(a, s) + 1)) AS BIGINT) AS bases, min(CASE WHEN least(b, e) >= greatest(a, s) THEN CASE WHEN Strand = '-' THEN x[1] + (e - least(b, e)) ELSE x[1] + greatest(a, s) - s END END) AS first
FROM (SELECT TrID, Strand, x, CASE WHEN Strand = '-' THEN n - c + 1 ELSE c - (x[2] - x[1]) END AS s, CASE WHEN Strand = '-' THEN n - c + 1 + (x[2] - x[1]) ELSE c END AS e, 101 AS a, 900 AS b FROM
(SELECT TrID, Strand, x, sum(x[2] - x[1] + 1) OVER (PARTITION BY TrID ORDER BY x[1]) AS c, sum(x[2] - x[1] + 1) OVER (PARTITION BY TrID) AS n FROM (SELECT TrID, Strand, unnest({EXL}) AS x FROM model))) GROUP BY TrID""")
def ribosome_walk(spark, sf):
    ex = chain.exons(F.col("TrStart"), chain.sites(F.col("SSC")), F.col("TrEnd"))
    m = model(spark, sf).select("TrID", chain.segments(ex, F.col("Strand"), F.lit(101), F.lit(900)).alias("x"))
    return m.select("TrID", chain.total(chain.exon_lengths(F.col("x"))).alias("bases"), F.array_min(F.transform("x", lambda e: e["s"])).alias("first"))


@query("""SELECT TrID, CASE WHEN tss AND tes THEN 'AlterTssTes' WHEN tss THEN 'AlterTss' WHEN tes THEN 'AlterTes' ELSE '' END AS flag FROM
(SELECT TrID, CASE WHEN Strand = '-' THEN h ELSE l END AS tss, CASE WHEN Strand = '-' THEN l ELSE h END AS tes FROM (SELECT *, frequency % 100 > 50 AS l, frequency % 77 > 50 AS h FROM model))""")
def terminal_flags(spark, sf):
    m = model(spark, sf).withColumns({"TrStart_ref": F.col("TrStart") - F.col("frequency") % 100, "TrEnd_ref": F.col("TrEnd") + F.col("frequency") % 77})
    return Q.terminal_flags(m).select("TrID", "flag")


@query("""SELECT GeneID, CASE WHEN strlen(x) <= 60 THEN x ELSE concat('Fusion_', substr(sha1(x), 1, 12)) END AS TrID FROM (SELECT GeneID, string_agg(TrID, '_' ORDER BY TrID) AS x FROM (SELECT DISTINCT GeneID, TrID FROM model) GROUP BY GeneID)""")
def combine_ids(spark, sf):
    return Q.fuse_ids(model(spark, sf), ["GeneID"], "TrID", "Fusion_", 60)


@query("SELECT * FROM (SELECT sample, TrID, GeneID, n AS count FROM tc)")
def tx_counts(spark, sf):
    return counted(spark, sf)


SAMPLES = ["s0", "s1", "s2"]


@query("""SELECT TrID, GeneID, CAST(coalesce(sum(n) FILTER (WHERE sample = 's0'), 0) AS BIGINT) AS s0, CAST(coalesce(sum(n) FILTER (WHERE sample = 's1'), 0) AS BIGINT) AS s1,
CAST(coalesce(sum(n) FILTER (WHERE sample = 's2'), 0) AS BIGINT) AS s2 FROM tc GROUP BY ALL HAVING count(*) >= 2""")
def tx_count_matrix(spark, sf):
    return Q.matrix(Q.expressed(counted(spark, sf), 3, 2), ["TrID", "GeneID"], SAMPLES, "count")


def rounded(df, keys):
    return df.select(*keys, *[F.round(s, 6).alias(s) for s in SAMPLES])


@query("""SELECT TrID, GeneID, round(coalesce(sum(x) FILTER (WHERE sample = 's0'), 0), 6) AS s0, round(coalesce(sum(x) FILTER (WHERE sample = 's1'), 0), 6) AS s1,
round(coalesce(sum(x) FILTER (WHERE sample = 's2'), 0), 6) AS s2 FROM (SELECT *, n * 1e6 / sum(n) OVER (PARTITION BY sample) AS x FROM tc) GROUP BY ALL""")
def tx_cpm_matrix(spark, sf):
    keys = ["TrID", "GeneID"]
    return rounded(Q.matrix(Q.cpm(counted(spark, sf)), keys, SAMPLES, "cpm"), keys)


@query("""SELECT GeneID, CAST(coalesce(sum(n) FILTER (WHERE sample = 's0'), 0) AS BIGINT) AS s0, CAST(coalesce(sum(n) FILTER (WHERE sample = 's1'), 0) AS BIGINT) AS s1,
CAST(coalesce(sum(n) FILTER (WHERE sample = 's2'), 0) AS BIGINT) AS s2 FROM gc GROUP BY ALL""")
def gene_count_matrix(spark, sf):
    return Q.matrix(Q.gene_counts(counted(spark, sf)), ["GeneID"], SAMPLES, "count")


@query("""SELECT GeneID, round(coalesce(sum(x) FILTER (WHERE sample = 's0'), 0), 6) AS s0, round(coalesce(sum(x) FILTER (WHERE sample = 's1'), 0), 6) AS s1,
round(coalesce(sum(x) FILTER (WHERE sample = 's2'), 0), 6) AS s2 FROM (SELECT *, n * 1e6 / sum(n) OVER (PARTITION BY sample) AS x FROM gc) GROUP BY ALL""")
def gene_cpm_matrix(spark, sf):
    """CPM per gene and library: scan, filter, collapse, loci, exact match, counts and pivot."""
    return rounded(Q.matrix(Q.cpm(Q.gene_counts(counted(spark, sf))), ["GeneID"], SAMPLES, "cpm"), ["GeneID"])


@query("""SELECT x.GeneID, m IS NOT NULL AS in_transcript_model, coalesce(m, 0) AS n_model_transcripts, t AS n_total_transcripts FROM (SELECT GeneID, count(DISTINCT TrID) AS t FROM model GROUP BY GeneID) x
LEFT JOIN (SELECT GeneID, count(*) AS m FROM model WHERE frequency >= 60 GROUP BY GeneID) USING (GeneID)""")
def gene_model_map(spark, sf):
    m = model(spark, sf)
    return Q.gene_model_map(m, m.where("frequency >= 60"), m)


@query(f"""SELECT Chr, Strand, SSC, concat('NovelGene', CAST(grp AS VARCHAR)) AS GeneID, concat('NovelGene', CAST(grp AS VARCHAR), '_NovelTr', CAST(row_number() OVER (PARTITION BY grp ORDER BY SSC) AS VARCHAR)) AS TrID FROM g""")
def novel_ids(spark, sf):
    return Q.novel_ids(located(spark, sf)).select(*C.KEY, "GeneID", "TrID")


@query(f"""SELECT Chr, Strand, grp AS {G}, SSC, GeneID, shared FROM (SELECT *, row_number() OVER (PARTITION BY grp, SSC ORDER BY shared DESC, GeneID) AS r FROM
(SELECT a.Chr, a.Strand, a.grp, a.SSC, b.GeneID, count(*) AS shared FROM (SELECT DISTINCT Chr, Strand, grp, SSC, unnest(t) AS site FROM g) a JOIN
(SELECT DISTINCT grp, concat('R', CAST(len(t) AS VARCHAR)) AS GeneID, unnest(t) AS site FROM ref) b USING (grp, site) GROUP BY ALL HAVING count(*) >= 2)) WHERE r = 1""")
def query_to_gene(spark, sf):
    r = reference(spark, sf).withColumn("GeneID", F.concat(F.lit("R"), F.size(F.split("SSC", "-")).cast("string")))
    return Q.query_genes(located(spark, sf), r)


@query("""SELECT 'tx_length' AS rule, count(*) FILTER (WHERE strlen(TrID) > 40) AS n FROM model UNION ALL SELECT 'gene_length', count(*) FILTER (WHERE strlen(GeneID) > 2) FROM model
UNION ALL SELECT 'tx_repeated', count(*) FROM (SELECT TrID FROM model GROUP BY TrID HAVING count(*) > 1)""")
def id_validation(spark, sf):
    return Q.check_ids(model(spark, sf), 40, 2)


@query("""SELECT count(DISTINCT Chr) FILTER (WHERE Chr LIKE 'chr%') AS prefixed, count(DISTINCT Chr) FILTER (WHERE Chr NOT LIKE 'chr%') AS bare,
CASE WHEN count(DISTINCT Chr) FILTER (WHERE Chr LIKE 'chr%') > count(DISTINCT Chr) FILTER (WHERE Chr NOT LIKE 'chr%') THEN 'prefixed' ELSE 'bare' END AS style FROM reads""")
def chrom_naming(spark, sf):
    return Q.naming_style(tables.reads(spark, sf))


@query("""SELECT '1.2' AS stage, input, output, round(100 * (input - output) / input, 6) AS drop_rate, CASE WHEN 100 * (input - output) / input >= 95 THEN 'fail' WHEN 100 * (input - output) / input >= 70 THEN 'warn' ELSE 'ok' END AS level
FROM (SELECT count(*) AS input, count(*) FILTER (WHERE frequency >= 5) AS output FROM c)""")
def stage_drops(spark, sf):
    raw = C.collapse(good(spark, sf))
    return Q.stage_drop("1.2", raw, C.supported(raw), 70, 95).withColumn("drop_rate", F.round("drop_rate", 6))


@query(f"""SELECT Chr, feature, s, e, attributes FROM (
SELECT Chr, 'gene' AS feature, min(lo) AS s, max(hi) AS e, concat('gene_id "', GeneID, '";') AS attributes FROM model GROUP BY Chr, Strand, GeneID
UNION ALL SELECT Chr, 'transcript', lo, hi, concat('gene_id "', GeneID, '"; transcript_id "', TrID, '";') FROM model
UNION ALL SELECT Chr, 'exon', x[1], x[2], concat('gene_id "', GeneID, '"; transcript_id "', TrID, '";') FROM (SELECT *, unnest({EXL}) AS x FROM model))""")
def gtf_rows(spark, sf):
    return Q.gtf_rows(model(spark, sf)).select("Chr", "feature", "s", "e", "attributes")


#: Transcripts with places of start and stop codons, of which some lie outside or are no pair.
CODING = f"""cod AS (SELECT *, CASE WHEN frequency % 5 = 0 THEN 'no_orf' WHEN frequency % 7 = 0 THEN 'NMD' ELSE 'Normal' END AS nmd, CASE WHEN frequency % 11 <> 0 THEN frequency * 7 % n END AS tis, frequency * 7 % n + frequency * 13 % n AS tts
FROM (SELECT *, {EXL} AS xs, CAST(list_sum(list_transform({EXL}, lambda x: x[2] - x[1] + 1)) AS BIGINT) AS n FROM model)),
px AS (SELECT *, CASE WHEN Strand = '-' THEN n - c + 1 ELSE c - (x[2] - x[1]) END AS p, CASE WHEN Strand = '-' THEN n - c + 1 + x[2] - x[1] ELSE c END AS q, nmd = 'Normal' AND tis IS NOT NULL AND tis + 1 < tts AND tts <= n AS codes
FROM (SELECT *, sum(x[2] - x[1] + 1) OVER (PARTITION BY TrID ORDER BY x[1]) AS c, row_number() OVER (PARTITION BY TrID ORDER BY x[1]) AS i, lead(x) OVER (PARTITION BY TrID ORDER BY x[1]) AS nx FROM (SELECT *, unnest(xs) AS x FROM cod))),
rg AS (SELECT *, greatest(p, a) AS u, least(q, b) AS v FROM (SELECT px.*, unnest([{{'k': 'before', 'a': 1, 'b': tis}}, {{'k': 'CDS', 'a': tis + 1, 'b': tts - 1}}, {{'k': 'behind', 'a': tts, 'b': n}}, {{'k': 'start', 'a': tis + 1, 'b': tis + 1}}, {{'k': 'stop', 'a': tts, 'b': tts}}], recursive := true) FROM px WHERE codes) WHERE greatest(p, a) <= least(q, b)),
pt AS (SELECT Chr, Strand, GeneID, TrID, k, CASE WHEN Strand = '-' THEN x[1] + q - v ELSE x[1] + u - p END AS s, CASE WHEN Strand = '-' THEN x[1] + q - u ELSE x[1] + v - p END AS e FROM rg)"""


@query(f"""SELECT Chr, Strand, feature, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e, phase, concat('gene_id "', GeneID, '";', CASE WHEN TrID <> '' THEN concat(' transcript_id "', TrID, '";') ELSE '' END, ' gene_name "', GeneID, '";', more) AS attributes FROM (
SELECT Chr, Strand, GeneID, '' AS TrID, 'gene' AS feature, min(lo) AS s, max(hi) AS e, '.' AS phase, '' AS more FROM model GROUP BY Chr, Strand, GeneID
UNION ALL SELECT Chr, Strand, GeneID, TrID, 'transcript', lo, hi, '.', '' FROM model
UNION ALL SELECT Chr, Strand, GeneID, TrID, 'exon', x[1], x[2], '.', concat(' exon_number "', i, '";') FROM px
UNION ALL SELECT Chr, Strand, GeneID, TrID, f, CASE WHEN (f = 'donor_site') = (Strand <> '-') THEN x[2] + 1 ELSE nx[1] - 2 END, CASE WHEN (f = 'donor_site') = (Strand <> '-') THEN x[2] + 2 ELSE nx[1] - 1 END, '.', concat(' junction_number "', i, '";') FROM px, (SELECT unnest(['donor_site', 'acceptor_site']) AS f) WHERE nx IS NOT NULL
UNION ALL SELECT Chr, Strand, GeneID, TrID, 'CDS', s, e, '0', '' FROM pt WHERE k = 'CDS'
UNION ALL SELECT Chr, Strand, GeneID, TrID, f, s, e, '.', '' FROM pt, (SELECT unnest(['UTR', 'UTR5', 'UTR3']) AS f) WHERE k IN ('before', 'behind') AND (f = 'UTR' OR (f = 'UTR5') = ((k = 'before') = (Strand <> '-')))
UNION ALL SELECT Chr, Strand, GeneID, TrID, 'start_codon', s - CASE WHEN Strand = '-' THEN 2 ELSE 0 END, s + CASE WHEN Strand = '-' THEN 0 ELSE 2 END, '.', '' FROM pt WHERE k = 'start'
UNION ALL SELECT Chr, Strand, GeneID, TrID, 'stop_codon', s - 1, s + 1, '.', '' FROM pt WHERE k = 'stop')""", with_=CODING)
def gtf_features(spark, sf):
    n = chain.total(chain.exon_lengths(chain.exons(F.col("TrStart"), chain.sites(F.col("SSC")), F.col("TrEnd"))))
    f = F.col("frequency")
    m = model(spark, sf).withColumns({"Predict_NMD": F.when(f % 5 == 0, "no_orf").when(f % 7 == 0, "NMD").otherwise("Normal"), "TIS_related_location": F.when(f % 11 != 0, f * 7 % n), "TTS_related_location": f * 7 % n + f * 13 % n})
    return Q.gtf_features(m).select("Chr", "Strand", "feature", "s", "e", "phase", "attributes")


@query("SELECT TrID, GeneID, GeneID AS GeneName, Chr, Strand, lo AS TrStart, hi AS TrEnd, SSC FROM model")
def gtf_parse(spark, sf):
    return tables.transcripts_of(tables.parse_gtf(Q.gtf_lines(Q.gtf_rows(model(spark, sf)))))


@query()
def annotation_downsample(spark, sf):
    return Q.downsample(model(spark, sf), 0.4).select("TrID", "GeneID")


@query("""SELECT vec_id, CASE WHEN b IS NULL THEN NULL ELSE CAST(-b.l - 32 AS INT) END AS "offset", round(CAST(b.h AS DOUBLE), 4) AS height FROM (SELECT vec_id, list_max(list_transform(list_filter(range(17, 48), lambda i: e[i+1] > e[i] AND e[i+1] > e[i+2] AND e[i+1] >= 0.01), lambda i: {'h': e[i+1], 'l': -i})) AS b FROM (SELECT vec_id, embedding AS e FROM embeddings))""")
def peak_pick(spark, sf):
    return spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", chain.peak(F.col("embedding"), 15).alias("p")).select("vec_id", "p.offset", "p.height")


ORF = """o AS (SELECT l_orderkey AS k, list({'at': CAST(l_partkey AS BIGINT), 's': l_discount} ORDER BY l_partkey, l_discount) AS a, list({'at': CAST(l_suppkey * 30 + l_linenumber AS BIGINT), 's': l_tax} ORDER BY l_suppkey, l_linenumber, l_tax) AS b FROM lineitem GROUP BY l_orderkey),
oo AS (SELECT k, x.at AS tis, y.at AS tts, x.s AS p, y.s AS q FROM (SELECT k, unnest(a) AS x, b FROM o), LATERAL (SELECT unnest(b) AS y) WHERE y.at > x.at AND (y.at - x.at) % 3 = 0)"""


def orf_table(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    a = F.array_sort(F.collect_list(F.struct(F.col("l_partkey").cast("bigint").alias("at"), F.col("l_discount").alias("score"))))
    b = F.array_sort(F.collect_list(F.struct((F.col("l_suppkey") * 30 + F.col("l_linenumber")).cast("bigint").alias("at"), F.col("l_tax").alias("score"))))
    return li.groupBy(F.col("l_orderkey").alias("k")).agg(a.alias("a"), b.alias("b")).select("k", F.explode(chain.orfs(F.col("a"), F.col("b"))).alias("o")).select("k", "o.*")


@query(f", {ORF} SELECT k, tis, tts, count(*) AS n FROM oo GROUP BY ALL")
def orf_pairing(spark, sf):
    return orf_table(spark, sf).groupBy("k", "tis", "tts").agg(F.count("*").alias("n"))


@query(f", {ORF} SELECT k, x.b AS tis, x.c AS tts FROM (SELECT k, max({{'a': round(p * q, 9), 'b': tis, 'c': tts}}) AS x FROM oo GROUP BY k)")
def best_orf(spark, sf):
    o = orf_table(spark, sf)
    return o.groupBy("k").agg(F.max(F.struct(F.round(F.col("tis_score") * F.col("tts_score"), 9).alias("a"), "tis", "tts")).alias("x")).select("k", "x.tis", "x.tts")


SCORED = """(SELECT *, CASE WHEN frequency % 4 = 0 THEN NULL ELSE frequency % 10 / 100.0 END AS tss, CASE WHEN frequency % 3 = 0 THEN 'NMD' WHEN frequency % 3 = 1 THEN 'no_orf' ELSE 'Normal' END AS nmd,
CASE WHEN frequency % 5 = 0 THEN 'yes' ELSE 'no' END AS truncation, CASE WHEN frequency % 6 = 0 THEN NULL WHEN frequency % 6 = 1 THEN 0 ELSE frequency % 100 / 100.0 END AS pa, CASE WHEN frequency % 7 < 3 THEN 'FSM' ELSE 'NIC' END AS category FROM model)"""


def scored(spark, sf):
    f = F.col("frequency")
    return model(spark, sf).withColumns({
        "tss_15": F.when(f % 4 != 0, f % 10 / 100.0), "tss_50": F.when(f % 4 != 0, f % 10 / 100.0),
        "nmd": F.when(f % 3 == 0, "NMD").when(f % 3 == 1, "no_orf").otherwise("Normal"), "truncation": F.when(f % 5 == 0, "yes").otherwise("no"),
        "polyA_frac": F.when(f % 6 == 0, None).when(f % 6 == 1, 0.0).otherwise(f % 100 / 100.0), "polyA_valid_reads": F.when(f % 6 == 1, 0).otherwise(f),
        "category": F.when(f % 7 < 3, "FSM").otherwise("NIC"),
    })


@query(f"""SELECT TrID FROM (SELECT *, coalesce(tss < 0.05, true) AS weak, CASE WHEN pa > 0 THEN pa < 0.5 WHEN pa = 0 AND frequency % 6 = 1 THEN category <> 'FSM' ELSE false END AS few, nmd = 'NMD' OR truncation = 'yes' AS doubted FROM {SCORED})
WHERE NOT ((doubted AND (weak OR few)) OR (weak AND few))""")
def soft_transcript_filter(spark, sf):
    return U.soft_filter(scored(spark, sf), 0.05, 0.5).select("TrID")


@query(f"SELECT TrID FROM {SCORED} WHERE tss > 0.02 AND (pa IS NULL OR pa > 0.5 OR (pa = 0 AND frequency % 6 = 1 AND category = 'FSM'))")
def hard_transcript_filter(spark, sf):
    return U.hard_filter(scored(spark, sf), 0.02, 0.5).select("TrID")


@query("""SELECT TrID, CASE WHEN h > 0.02 AND Strand = '+' THEN lo + o - 1 ELSE lo END AS TrStart, CASE WHEN h > 0.02 AND Strand <> '+' THEN hi - o + 1 ELSE hi END AS TrEnd
FROM (SELECT *, frequency % 31 - 15 AS o, CASE WHEN frequency % 4 > 0 THEN frequency % 10 / 100.0 END AS h FROM model)""")
def tss_shift(spark, sf):
    f = F.col("frequency")
    m = model(spark, sf).withColumns({"tss_offset": f % 31 - 15, "tss_height": F.when(f % 4 > 0, f % 10 / 100.0)})
    return U.shift_starts(m).select("TrID", "TrStart", "TrEnd")


@query("""SELECT Chr, Strand, SSC, s AS TrStart, e AS TrEnd, CAST(sum(frequency) AS BIGINT) AS frequency, arg_min(name, {'s': TrStart, 'e': TrEnd}) AS name, arg_min({'h': h}, {'s': TrStart, 'e': TrEnd}).h AS tss_height FROM
(SELECT *, CASE WHEN h > 0.02 AND Strand = '+' THEN TrStart - TrStart % 3 ELSE TrStart END AS s, CASE WHEN h > 0.02 AND Strand <> '+' THEN TrEnd - TrEnd % 3 ELSE TrEnd END AS e FROM
(SELECT *, concat(TrStart, ':', TrEnd) AS name, CASE WHEN TrEnd % 4 > 0 THEN TrStart % 10 / 100.0 END AS h FROM (SELECT Chr, Strand, SSC, TrStart, TrEnd, count(*) AS frequency FROM q WHERE SSC IS NOT NULL GROUP BY ALL))) GROUP BY ALL""")
def tss_reaggregate(spark, sf):
    t = placed_reads(spark, sf).groupBy(*Q.ENDS).agg(F.sum("n").alias("frequency"))
    offset = F.when(F.col("Strand") == "+", 1 - F.col("TrStart") % 3).otherwise(1 + F.col("TrEnd") % 3)
    t = t.withColumns({"name": F.concat_ws(":", "TrStart", "TrEnd"), "tss_offset": offset, "tss_height": F.when(F.col("TrEnd") % 4 > 0, F.col("TrStart") % 10 / 100.0)})
    return X.shift_and_sum(t).drop("tss_offset")


@query("""SELECT coalesce(m.Chr, p.Chr) AS Chr, coalesce(m.Strand, p.Strand) AS Strand, TrID, h AS height FROM (SELECT *, CASE WHEN Strand = '+' THEN lo ELSE hi END AS at FROM model) m
FULL JOIN (SELECT Chr, Strand, CASE WHEN Strand = '+' THEN lo ELSE hi END + CASE WHEN frequency % 7 = 0 THEN 1 ELSE 0 END AS at, frequency % 10 / 10.0 AS h FROM model WHERE frequency % 3 > 0) p ON m.Chr = p.Chr AND m.Strand = p.Strand AND m.at = p.at""")
def tss_score_join(spark, sf):
    """Model transcripts and scored places, of which some are none of their starts."""
    m, f = model(spark, sf), F.col("frequency")
    at = F.when(F.col("Strand") == "+", F.col("TrStart")).otherwise(F.col("TrEnd")) + F.when(f % 7 == 0, 1).otherwise(0)
    peak = F.struct(F.lit(0).alias("offset"), (f % 10 / 10.0).alias("height"))
    places = m.where(f % 3 > 0).select("Chr", "Strand", at.alias("query_tss"), peak.alias("tss_15"), peak.alias("tss_50"))
    return X.with_tss_scores(m, places).select("Chr", "Strand", "TrID", F.col("tss_15.height").alias("height"))


@query(f"""SELECT TrID, coalesce(CAST(b.a AS VARCHAR), 'no') AS tis, coalesce(CAST(b.z AS VARCHAR), 'no') AS tts, CASE WHEN b IS NULL OR b.p < 0.9 OR b.q < 0.9 THEN 'no_orf' WHEN (len(t) > 1 AND b.z <= n - last - 55) OR n - b.z > 1000 THEN 'NMD' ELSE 'Normal' END AS nmd FROM
(SELECT *, CAST(list_sum(l) AS BIGINT) AS n, CASE WHEN Strand = '-' THEN l[1] ELSE l[-1] END AS last FROM (SELECT *, list_transform({EXL}, lambda x: x[2] - x[1] + 1) AS l FROM model)) LEFT JOIN
(SELECT TrID, max(struct_pack(p := p, q := q, ma := -a, mz := -z, a := a, z := z)) AS b FROM (SELECT TrID, frequency * k % 500 AS a, frequency * k % 500 + 30 * k * k + frequency % 7 AS z, (frequency * k % 4 + 96) / 100.0 - 0.05 AS p, 0.8 + k * frequency % 3 / 10.0 AS q
FROM model, (SELECT unnest([1, 2, 3]) AS k) WHERE frequency % 6 > 0) GROUP BY TrID) USING (TrID)""")
def frame_join(spark, sf):
    """The best of three frames of most model transcripts, brought back to them."""
    m, f, k = model(spark, sf), F.col("frequency"), F.col("k")
    start = f * k % 500
    frames = m.where(f % 6 > 0).withColumn("k", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    frames = frames.select(*Q.ENDS, start.alias("TIS_related_location"), (start + 30 * k * k + f % 7).alias("TTS_related_location"), ((f * k % 4 + 96) / 100.0 - 0.05).alias("TIS_score"), (0.8 + k * f % 3 / 10.0).alias("TTS_score"))
    out = X.spelled(X.with_frames(m, frames))
    return out.select("TrID", F.col("TIS_related_location").alias("tis"), F.col("TTS_related_location").alias("tts"), F.col("Predict_NMD").alias("nmd"))


@query("""SELECT TrID, GeneID, s0, s1, s2, CAST(c0 AS DOUBLE) AS c0 FROM (SELECT k.TrID, k.GeneID, CAST(coalesce(sum(n) FILTER (WHERE sample = 's0'), 0) AS BIGINT) AS s0, CAST(coalesce(sum(n) FILTER (WHERE sample = 's1'), 0) AS BIGINT) AS s1,
CAST(coalesce(sum(n) FILTER (WHERE sample = 's2'), 0) AS BIGINT) AS s2, coalesce(sum(n) FILTER (WHERE sample = 's0' AND hash_ok), 0) / 2 AS c0 FROM
(SELECT DISTINCT TrID, GeneID FROM (SELECT CASE WHEN TrStart % 5 = 0 THEN concat(TrID, '_more') ELSE TrID END AS TrID, GeneID FROM model_tr)) k LEFT JOIN (SELECT *, length(TrID) % 2 = 0 AS hash_ok FROM tc) USING (TrID, GeneID) GROUP BY ALL) WHERE greatest(s0, s1, s2) >= 3""")
def matrices_of_model(spark, sf):
    """Counts, and a second matrix without some of their rows, for a model that has some other transcripts."""
    keys = ["TrID", "GeneID"]
    n = counted(spark, sf)
    counts = Q.matrix(n, keys, SAMPLES, "count")
    some = counts.where(F.length("TrID") % 2 == 0).select(*keys, (F.col("s0") / 2).alias("c0"))
    m = transcripts(spark, sf).withColumn("TrID", F.when(F.col("TrStart") % 5 == 0, F.concat("TrID", F.lit("_more"))).otherwise(F.col("TrID")))
    _, out = P.matrices_of_model(m, {"transcript.counts": counts, "transcript.cpm": some}, keys, least=3)
    return out["transcript.counts"].join(out["transcript.cpm"], keys)


@query("""SELECT Chr, Strand, SSC, s AS TrStart, e AS TrEnd, u AS uniqueTr, CASE WHEN row_number() OVER w > 1 THEN concat(id, '_', row_number() OVER w) ELSE id END AS TrID, gene AS GeneID, route FROM (
SELECT u.*, concat(a.id, CASE WHEN hit THEN '' WHEN CASE WHEN Strand = '-' THEN abs(ne - e) ELSE abs(ns - s) END > 50 AND CASE WHEN Strand = '-' THEN abs(ns - s) ELSE abs(ne - e) END > 50 THEN '_AlterTssTes'
WHEN CASE WHEN Strand = '-' THEN abs(ne - e) ELSE abs(ns - s) END > 50 THEN '_AlterTss' WHEN CASE WHEN Strand = '-' THEN abs(ns - s) ELSE abs(ne - e) END > 50 THEN '_AlterTes' ELSE '' END) AS id, a.gene, 'reference' AS route FROM u JOIN a USING (u)
UNION ALL SELECT u.*, concat(coalesce(b.gene, concat('NovelGene', grp)), '_Novel', u), coalesce(b.gene, concat('NovelGene', grp)), CASE WHEN b.gene IS NULL THEN 'novel' ELSE 'gene' END FROM u LEFT JOIN b USING (u) WHERE u NOT IN (SELECT u FROM a))
WINDOW w AS (PARTITION BY id ORDER BY concat(Chr, Strand, ':', s, '-', SSC, '-', e))""", with_="""u AS (SELECT *, concat('Tr', row_number() OVER (ORDER BY Chr, Strand, SSC, s, e) - 1) AS u FROM
(SELECT Chr, Strand, SSC, grp, t, lo AS s, hi AS e FROM g UNION ALL SELECT Chr, Strand, SSC, grp, t, lo - 60, hi FROM g WHERE frequency % 4 = 0)),
rf AS (SELECT Chr, Strand, SSC, concat('R', grp, '_', SSC) AS TrID, concat('G', grp) AS GeneID, lo AS rs, hi AS re FROM g WHERE frequency >= 20 AND grp % 2 = 0
UNION ALL SELECT Chr, Strand, SSC, concat('S', grp, '_', len(t)), concat('H', grp), lo - 200, hi + 70 FROM g WHERE frequency >= 10 AND frequency % 3 = 0 AND grp % 4 > 0),
m AS (SELECT *, bool_or(near) OVER (PARTITION BY u) AS hit FROM (SELECT u.*, TrID, GeneID, rs, re, abs(s - rs) <= 50 AND abs(e - re) <= 50 AS near FROM u JOIN rf USING (Chr, Strand, SSC))),
a AS (SELECT u, string_agg(DISTINCT TrID, '_' ORDER BY TrID) AS id, string_agg(DISTINCT GeneID, '-' ORDER BY GeneID) AS gene, bool_or(hit) AS hit, min({'d': abs(rs - s), 'x': rs}).x AS ns, min({'d': abs(re - e), 'x': re}).x AS ne FROM m WHERE near OR NOT hit GROUP BY u),
gs AS (SELECT DISTINCT grp, GeneID, unnest(list_concat([s, e], t)) AS site FROM m WHERE near OR NOT hit),
b AS (SELECT u, min({'n': -n, 'g': GeneID}).g AS gene FROM (SELECT x.u, GeneID, count(*) AS n FROM (SELECT u, grp, unnest(list_distinct(list_concat([s, e], t))) AS site FROM u) x JOIN gs USING (grp, site) GROUP BY ALL HAVING count(*) >= 2) GROUP BY u)""")
def annotate(spark, sf):
    """All chains, some with a second start, named after a reference of some of them."""
    g, f, grp = located(spark, sf), F.col("frequency"), F.col("Group").cast("string")
    ends = {"TrStart": F.col("lo"), "TrEnd": F.col("hi")}
    t = g.withColumns(ends).unionByName(g.where(f % 4 == 0).withColumns({**ends, "TrStart": F.col("lo") - 60}))
    name = lambda x, last: F.concat(F.lit(x), grp, F.lit("_"), last)
    one = g.where((f >= 20) & (F.col("Group") % 2 == 0)).withColumns({**ends, "TrID": name("R", F.col("SSC")), "GeneID": F.concat(F.lit("G"), grp)})
    two = g.where((f >= 10) & (f % 3 == 0) & (F.col("Group") % 4 > 0)).withColumns({"TrStart": F.col("lo") - 200, "TrEnd": F.col("hi") + 70, "TrID": name("S", F.size(chain.sites(F.col("SSC"))).cast("string")), "GeneID": F.concat(F.lit("H"), grp)})
    reference = one.unionByName(two).withColumn("GeneName", F.col("GeneID"))
    return N.annotate(t, reference, remap=False).select(*Q.ENDS, "uniqueTr", "TrID", "GeneID", "route")


@query("""SELECT Chr, Strand, SSC, TrStart, TrEnd, min(TrID) AS TrID, min(GeneID) AS GeneID FROM (SELECT *, lo AS TrStart, hi AS TrEnd FROM model UNION ALL SELECT * REPLACE (concat(TrID, '_2') AS TrID), lo, hi FROM model) GROUP BY ALL""")
def assessment_table(spark, sf):
    m = model(spark, sf)
    twice = m.unionByName(m.withColumn("TrID", F.concat("TrID", F.lit("_2"))))
    return P.assessment(twice, core=(*Q.ENDS, "TrID", "GeneID"))


@query("""SELECT stage, CAST(came AS BIGINT) AS "input", CAST(went AS BIGINT) AS "output", round(100 * (1 - went / came), 2) AS drop_rate, CASE WHEN 100 * (1 - went / came) >= f THEN 'FAIL' WHEN 100 * (1 - went / came) >= w THEN 'WARNING' ELSE 'INFO' END AS level FROM (
SELECT '1.2' AS stage, (SELECT count(*) FROM c) AS came, (SELECT count(*) FROM c WHERE frequency >= 5) AS went, 70 AS w, 95 AS f UNION ALL
SELECT 'long', (SELECT count(*) FROM c WHERE frequency >= 5), (SELECT count(*) FROM st WHERE frequency >= 5 AND len(t) >= 4), 20, 60)""")
def guarded_stages(spark, sf):
    log = f"{shared_dir(spark).rstrip('/')}/stage-log-{uuid.uuid4().hex}"
    guard = guards.Guard(spark, log, thresholds={**guards.THRESHOLDS, "long": (20.0, 60.0)})
    kept = guard.run("1.2", collapsed(spark, sf), C.supported)
    guard.run("long", kept, lambda x: x.where(F.size(F.split("SSC", "-")) >= 4))
    return spark.read.schema(guards.RECORD).json(log).select("stage", "input", "output", "drop_rate", "level")


@query("""SELECT uniqueTr, concat(CASE WHEN strlen(x) <= 200 THEN x ELSE concat('Fusion_', substr(sha1(x), 1, 12)) END, CASE WHEN nn > 0 THEN '' WHEN tss AND tes THEN '_AlterTssTes' WHEN tss THEN '_AlterTss' WHEN tes THEN '_AlterTes' ELSE '' END) AS TrID FROM
(SELECT *, CASE WHEN nn > 0 THEN a ELSE b END AS x, CASE WHEN Strand = '-' THEN de ELSE ds END > 300 AS tss, CASE WHEN Strand = '-' THEN ds ELSE de END > 300 AS tes FROM
(SELECT m.TrID AS uniqueTr, m.Strand, count(*) FILTER (WHERE abs(m.lo - r.lo) <= 300 AND abs(m.hi - r.hi) <= 300) AS nn, string_agg(r.TrID, '_' ORDER BY r.TrID) FILTER (WHERE abs(m.lo - r.lo) <= 300 AND abs(m.hi - r.hi) <= 300) AS a,
string_agg(r.TrID, '_' ORDER BY r.TrID) AS b, min(abs(m.lo - r.lo)) AS ds, min(abs(m.hi - r.hi)) AS de FROM model m JOIN (SELECT grp, TrID, lo - frequency * 37 % 1000 AS lo, hi FROM model) r USING (grp) GROUP BY ALL))""")
def reference_collapse(spark, sf):
    m = model(spark, sf)
    r = m.select("Group", "TrID", (F.col("TrStart") - F.col("frequency") * 37 % 1000).alias("TrStart_ref"), F.col("TrEnd").alias("TrEnd_ref"))
    rows = m.withColumnRenamed("TrID", "uniqueTr").join(r, "Group")
    return U.one_per_transcript(rows, 300).select("uniqueTr", "TrID")


@query()
def consensus_filter(spark, sf):
    g = located(spark, sf)
    return C.drop_sites(g, U.off_consensus(g)).select(*C.KEY)


@query(f"""SELECT TrID, md5(CASE WHEN Strand = '-' THEN reverse(translate(s, 'ACGT', 'TGCA')) ELSE s END) AS seq_md5, CAST(length(s) AS INT) AS seq_len FROM (SELECT TrID, Strand, string_agg(substr(seq, x[1], x[2] - x[1] + 1), '' ORDER BY x[1]) AS s FROM
(SELECT TrID, Strand, Chr, unnest({EXL}) AS x FROM model) JOIN (SELECT concat('chr', CAST(i AS VARCHAR)) AS Chr, repeat(concat(repeat('GAT', i), 'TACACCTG'), 100000) AS seq FROM range(1, 6) r(i)) USING (Chr) GROUP BY ALL)""")
def transcript_fasta(spark, sf):
    out = U.transcript_sequences(model(spark, sf), U.genome_bins(contigs(spark)))
    return out.select("TrID", F.md5(F.col("seq").cast("binary")).alias("seq_md5"), "seq_len")


@query(f", {ORF} SELECT k, list_sum(list_transform(x, lambda y: y.at)) AS total, CAST(len(x) AS INT) AS n FROM (SELECT k, list_reverse_sort(list_transform(a, lambda y: {{'s': y.s, 'at': y.at}}))[1:2] AS x FROM o)")
def best_sites(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    s = li.groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_list(F.struct(F.col("l_partkey").cast("bigint").alias("at"), F.col("l_discount").alias("score"))).alias("a"))
    best = s.select("k", chain.best_scored(F.col("a"), 2).alias("x"))
    return best.select("k", chain.total(F.transform("x", lambda y: y["at"])).alias("total"), F.size("x").alias("n"))


FORK46 = """ex2 AS (SELECT grp, Chr, Strand, frequency, ext, frequency >= 20 AND grp % 2 = 0 AND len(t) >= 4 AS known FROM ex),
ed AS (SELECT DISTINCT grp, ext[i] AS u, ext[i+1] AS v FROM (SELECT *, unnest(range(1, len(ext))) AS i FROM ex2)),
fo AS (SELECT grp, u FROM ed GROUP BY ALL HAVING count(*) > 1), me AS (SELECT grp, v FROM ed GROUP BY ALL HAVING count(*) > 1),
p4 AS (SELECT Chr, Strand, grp, ext[i:i+3] AS p, sum(frequency) AS f, bool_or(known) AS k FROM (SELECT *, unnest(range(1, len(ext) - 2)) AS i FROM ex2) GROUP BY ALL),
p6 AS (SELECT grp, ext[i:i+5] AS p, sum(frequency) AS f, bool_or(known) AS k FROM (SELECT *, unnest(range(1, len(ext) - 4)) AS i FROM ex2) GROUP BY ALL),
fp AS (SELECT a.Chr, a.Strand, a.grp, a.p[2:3] AS i4, b.p[2:5] AS i6, a.f AS f4, b.f AS f6, a.k AS k4, b.k AS k6, abs(a.p[2] - a.p[1] + a.p[4] - a.p[3] - (b.p[2] - b.p[1] + b.p[4] - b.p[3] + b.p[6] - b.p[5])) AS d,
  min(CASE WHEN a.k AND b.k THEN 1 ELSE 0 END) OVER (PARTITION BY a.grp, a.p[1], a.p[4]) AS allk
  FROM p4 a JOIN p6 b ON a.grp = b.grp AND a.p[1] = b.p[1] AND a.p[4] = b.p[6] JOIN fo ON fo.grp = a.grp AND fo.u = a.p[1] JOIN me ON me.grp = a.grp AND me.v = a.p[4])"""


def known_pairs(spark, sf):
    k = (F.col("frequency") >= 20) & (F.col("Group") % 2 == 0) & (F.size(F.split("SSC", "-")) >= 4)
    return C.fork_pairs(located(spark, sf).withColumn("known", k))


@query(f""", {FORK46} SELECT DISTINCT Chr, Strand, grp AS {G}, array_to_string(CASE WHEN f4 < f6 THEN i4 ELSE i6 END, '-') AS fragment FROM fp
WHERE d <= 40 AND least(f4, f6) / greatest(f4, f6) < 0.5 AND allk = 0 AND (CASE WHEN f4 < f6 THEN k6 ELSE k4 END OR NOT (k4 OR k6))""")
def exon_jump_forks(spark, sf):
    return C.exon_jump_errors(known_pairs(spark, sf), 40, 0.5).withColumn("fragment", chain.joined(F.col("fragment")))


@query(f""", {FORK46} SELECT DISTINCT Chr, Strand, grp AS {G}, array_to_string(CASE WHEN f4 < f6 THEN i4 ELSE i6 END, '-') AS fragment FROM fp
WHERE d <= 50 AND least(f4, f6) / greatest(f4, f6) < 0.5 AND CASE WHEN f4 < f6 THEN k6 ELSE k4 END AND k4 <> k6""")
def fake_exon_forks(spark, sf):
    return C.fake_exon_errors(known_pairs(spark, sf), ratio=0.5).withColumn("fragment", chain.joined(F.col("fragment")))


NEAREST = """cr AS (SELECT *, frequency >= 10 AND len(t) = 6 AS isref, sum(frequency) OVER (PARTITION BY grp) AS reads FROM g),
rs AS (SELECT grp, list(DISTINCT site) AS refs FROM (SELECT grp, unnest(t) AS site FROM cr WHERE isref) GROUP BY grp),
nr AS (SELECT *, list_transform(t, lambda x: list_min(list_transform(refs, lambda r: {'d': abs(r - x), 'r': r})).r) AS m FROM cr JOIN rs USING (grp) WHERE NOT isref),
nn AS (SELECT *, len(list_filter(range(1, len(t) + 1), lambda j: t[j] <> m[j])) AS n FROM nr),
pa AS (SELECT DISTINCT grp, t[i:i+3] AS p FROM (SELECT *, unnest(range(1, len(t) - 2, 2)) AS i FROM cr WHERE isref) WHERE t[i+2] - t[i+1] < {little})"""
MAPPED = """SELECT g.Chr, g.Strand, g.SSC, coalesce(f.x, g.SSC) AS mapped_SSC FROM g LEFT JOIN
(SELECT DISTINCT k.grp, k.SSC, array_to_string(k.x, '-') AS x FROM k JOIN cr ON cr.grp = k.grp AND isref AND len(list_filter(range(1, len(cr.t) - len(k.x) + 2), lambda j: cr.t[j : j + len(k.x) - 1] = k.x)) > 0) f USING (grp, SSC)"""


def mapped(spark, sf, little):
    g = located(spark, sf)
    ends = C.mean_ends(good(spark, sf))
    ref = g.where((F.col("frequency") >= 10) & (F.size(F.split("SSC", "-")) == 6))
    return R.map_to_reference(C.categories(g, ref).join(ends, C.KEY), ref, little).select(*C.KEY, "mapped_SSC")


@query(f""", {NEAREST.replace("{little}", "30")}, k AS (SELECT grp, SSC, min({{'p': p, 'x': list_concat(m[1:i-1], p, m[i+2:])}}).x AS x FROM (SELECT *, unnest(range(1, len(m))) AS i FROM nn) JOIN pa USING (grp)
WHERE m[i] = p[1] AND m[i+1] = p[4] AND n = (CASE WHEN t[i] <> m[i] THEN 1 ELSE 0 END) + (CASE WHEN t[i+1] <> m[i+1] THEN 1 ELSE 0 END) AND t[i] >= p[1] AND t[i+1] <= p[4] GROUP BY ALL) {MAPPED}""")
def map_little_exons(spark, sf):
    return mapped(spark, sf, 30)


# in these data, only single sites are displaced
@query(f""", {NEAREST.replace("{little}", "1")}, k AS (SELECT grp, SSC, m AS x FROM nn WHERE n = 1 AND frequency / reads < 0.25 AND abs(list_sum(t) - list_sum(m)) < 20) {MAPPED}""")
def map_shifted_sites(spark, sf):
    return mapped(spark, sf, 1)


@query("""SELECT TrID AS old, concat(id, e) AS TrID, id AS GeneID FROM (SELECT m.TrID, m.grp, concat('_', split_part(m.TrID, '_', 2)) AS e FROM model m) JOIN
(SELECT grp, CASE WHEN count(*) = 1 THEN min(R) ELSE concat('NovelGeneCluster_', string_agg(R, '_' ORDER BY R)) END AS id FROM (SELECT *, bool_or(n = size) OVER (PARTITION BY grp) AS af, max(n) OVER (PARTITION BY grp) AS mx FROM
(SELECT r.grp, R, count(*) AS n, size FROM (SELECT DISTINCT grp, concat('R', CAST(grp AS VARCHAR), CAST(len(t) AS VARCHAR)) AS R, unnest(t) AS site FROM ref) r JOIN (SELECT DISTINCT grp, unnest(t) AS site FROM model) q USING (grp, site)
JOIN (SELECT R, count(DISTINCT site) AS size FROM (SELECT concat('R', CAST(grp AS VARCHAR), CAST(len(t) AS VARCHAR)) AS R, unnest(t) AS site FROM ref) GROUP BY R) USING (R) GROUP BY ALL HAVING count(*) >= 2)) WHERE CASE WHEN af THEN n = size ELSE n = mx END GROUP BY grp) USING (grp)
UNION ALL SELECT TrID, TrID, concat('NovelGene', GeneID) FROM model WHERE grp NOT IN (SELECT grp FROM ref)""")
def novel_gene_remap(spark, sf):
    m = model(spark, sf).withColumns({"old": F.col("TrID"), "GeneID": F.concat(F.lit("NovelGene"), "GeneID"), "GeneName": F.lit("novel")})
    gene = F.concat(F.lit("R"), F.col("Group").cast("string"), F.size(F.split("SSC", "-")).cast("string"))
    r = reference(spark, sf).withColumns({"GeneID": gene, "GeneName": gene})
    return R.remap_novel_genes(m, r).select("old", "TrID", "GeneID")


@query()
def isoform_pipeline(spark, sf):
    """Reads to transcripts with ends, category, truncation and tails."""
    stages = Staged(spark, "pipeline")
    reads = paired_reads(spark, sf)
    g, known = C.loci_with(C.supported(collapsed(spark, sf)), reference(spark, sf))
    g, known = stages.write(H.mark_known(g, known), "loci"), stages.write(known.select(*C.KEY, "Group"), "known")
    g = stages.write(C.drop_sites(g, H.error_sites(g)), "sites")
    g = stages.write(H.drop_fragments(g, H.jump_errors(g)).drop("known"), "jumps")
    ends = T.terminal_pairs(reads, "n", paired=True).withColumnRenamed("frequency", "reads")
    out = C.truncation(C.categories(g, known)).join(ends, C.KEY)
    named = stages.write(Q.novel_ids(out.drop("lo", "hi")), "named")
    return T.polya_fraction(T.correct_reads(reads, named, chains=collapsed(spark, sf)), named, "n", "n_tails")


def _checkpoints(spark: SparkSession) -> None:
    """Sets a checkpoint folder where the context has none."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_dir(spark))
