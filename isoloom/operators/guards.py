"""Stages that count what they drop while they are written, and stop where that is too much."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from isoloom.stages import Staged

log = logging.getLogger(__name__)

#: Percent of rows dropped from which a stage warns and fails.
THRESHOLDS = {"1.2": (70.0, 95.0), "1.4": (15.0, 50.0), "1.5": (30.0, 70.0), "1.8": (50.0, 85.0), "2.5b": (50.0, 90.0), "2.6": (60.0, 90.0)}
OTHERS = (50.0, 80.0)
#: Contigs whose names tell the style of a file, without and with "chr" before them.
CANONICAL = (*map(str, range(1, 23)), "X", "Y", "M", "MT")
RECORD = "timestamp string, stage string, input bigint, output bigint, drop_rate double, level string, metadata string"


class StageError(RuntimeError):
    """A stage dropped all its rows, or more than it may."""


class Guard:
    """Runs stages as written tables and checks how many of their rows they keep.

    ``strict`` stops a stage that reaches its fail limit; without it only one that drops
    everything stops, unless ``allow_zero``. ``log_path`` is a folder of JSON lines that
    every checked stage is appended to, warnings and failures included. Limits are percents,
    those in ``thresholds`` or else ``others``.
    """

    def __init__(self, spark: SparkSession, log_path: str | None = None, strict: bool = False, allow_zero: bool = False, thresholds: dict[str, tuple[float, float]] | None = None, others: tuple[float, float] = OTHERS):
        self.spark, self.log_path, self.strict, self.allow_zero = spark, log_path, strict, allow_zero
        self.thresholds, self.others = THRESHOLDS if thresholds is None else thresholds, others
        self.staged = Staged(spark, "guarded")
        self.written = 0

    def run(self, stage: str, before: DataFrame, step: Callable[[DataFrame], DataFrame], metadata: dict | None = None) -> DataFrame:
        """The table that ``step`` makes of ``before``, written. Both are counted by the job that writes it.

        ``step`` must read what it is given, once. A stage without input is passed over.
        ``metadata`` is only logged.
        """
        came, went = Observation(), Observation()
        n = F.count(F.lit(1)).alias("n")
        out = step(before.observe(came, n)).observe(went, n)
        self.written += 1
        out = self.staged.write(out, f"{self.written}-{stage}")
        self.check(stage, came.get["n"], went.get["n"], metadata)
        return out

    def level(self, stage: str, rate: float) -> str:
        warn, fail = self.thresholds.get(stage, self.others)
        return "FAIL" if rate >= fail else "WARNING" if rate >= warn else "INFO"

    def check(self, stage: str, came: int, went: int, metadata: dict | None = None) -> str | None:
        """Logs the stage and says its level; raises StageError where it must stop."""
        if not came:
            return None
        rate = 100 * (1 - went / came)
        level = self.level(stage, rate)
        (log.info if level == "INFO" else log.warning)("stage %s: %d of %d rows kept, %.2f percent dropped", stage, went, came, rate)
        if self.log_path:
            record = (datetime.now().strftime("%Y-%m-%d %H:%M:%S"), stage, came, went, round(rate, 2), level, json.dumps(metadata) if metadata else None)
            self.spark.createDataFrame([record], RECORD).coalesce(1).write.mode("append").json(self.log_path)
        if not went and not self.allow_zero:
            raise StageError(f"stage {stage} keeps none of {came} rows")
        if self.strict and level == "FAIL":
            raise StageError(f"stage {stage} drops {rate:.2f} percent of {came} rows")
        return level


def require_frames(transcripts: DataFrame, least: int = 50) -> None:
    """Raises if over ``least`` transcripts have no place of a start codon at all; 0 asks for nothing."""
    if least:
        n, found = transcripts.agg(F.count(F.lit(1)), F.count("TIS_related_location")).first()
        if n > least and not found:
            raise StageError(f"none of {n} transcripts has a reading frame")


class ContigError(ValueError):
    """Reads and sequences do not name their contigs alike."""


def contig_shares(reads: DataFrame, sequences: DataFrame) -> DataFrame:
    """(prefixed, sequences_prefixed, expected, matched) of distinct contig names (Chr on both sides): whether
    most canonical names of each side begin with chr, and how many of the reads' canonical contigs, in the style
    of the reads, there are, and have a sequence. A single row."""
    canonical = F.regexp_replace("Chr", "^chr", "").isin(*CANONICAL)
    chr_ = F.col("Chr").startswith("chr")
    told = reads.select("Chr", F.lit(1).alias("r"), F.lit(0).alias("s")).distinct().unionByName(sequences.select("Chr", F.lit(0).alias("r"), F.lit(1).alias("s")).distinct())
    names = told.where("Chr is not null").groupBy("Chr").agg(F.max("r").alias("r"), F.max("s").alias("s")).where(canonical)
    count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0))
    r, s = F.col("r") == 1, F.col("s") == 1
    n = names.agg(count(r & chr_).alias("rc"), count(r & ~chr_).alias("rb"), count(s & chr_).alias("sc"), count(s & ~chr_).alias("sb"), count(r & s & chr_).alias("bc"), count(r & s & ~chr_).alias("bb"))
    style = F.col("rc") > F.col("rb")
    return n.select(style.alias("prefixed"), (F.col("sc") > F.col("sb")).alias("sequences_prefixed"), F.when(style, F.col("rc")).otherwise(F.col("rb")).alias("expected"), F.when(style, F.col("bc")).otherwise(F.col("bb")).alias("matched"))


def check_contigs(reads: DataFrame, sequences: DataFrame, warn: float = 0.9, fail: float = 0.5) -> float | None:
    """The share of the reads' canonical contigs that have a sequence, or None without such contigs.

    Raises ContigError if reads and sequences have different styles, or the share is below
    ``fail``; logs a warning below ``warn``. Reads without contigs pass.
    """
    if not reads.where("Chr is not null").take(1):
        return None
    x = contig_shares(reads, sequences).first()
    if x.prefixed != x.sequences_prefixed:
        raise ContigError("reads and sequences name contigs in different styles, with and without chr")
    if not x.expected:
        return None
    share = x.matched / x.expected
    if share < fail:
        raise ContigError(f"{x.matched} of {x.expected} canonical contigs of the reads have a sequence")
    if share < warn:
        log.warning("%d of %d canonical contigs of the reads have a sequence", x.matched, x.expected)
    return share


def when_most_are_dropped(before: DataFrame, after: DataFrame, step: Callable[[DataFrame], DataFrame], share: float = 0.55) -> DataFrame:
    """step(after), if fewer than ``share`` of the rows were kept so far, else after; both are counted.
    Without any rows before, after."""
    n, kept = before.count(), after.count()
    return step(after) if n and kept / n < share else after
