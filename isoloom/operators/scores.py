"""Scores of transcript starts and reading frames brought to transcripts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloom.functions import chain
from isoloom.operators.chains import KEY
from isoloom.operators.curate import shift_starts

ENDS = [*KEY, "TrStart", "TrEnd"]
FRAME = ["TIS_related_location", "TTS_related_location", "TIS_score", "TTS_score"]


def with_tss_scores(transcripts: DataFrame, scores: DataFrame) -> DataFrame:
    """Transcripts with tss_15 and tss_50 of the scored place that their 5' end is, TrStart on the plus
    strand and TrEnd elsewhere; null where it was not scored.

    Places that no transcript begins at are rows of their own, with contig and strand alone, if
    there are transcripts on that strand. Several scores of a place, or transcripts that begin
    at one, give a row for each pair. Without transcripts there is no row.
    """
    start = F.when(F.col("Strand") == "+", F.col("TrStart")).otherwise(F.col("TrEnd"))
    t = transcripts.withColumn("query_tss", start)
    s = scores.join(transcripts.select("Chr", "Strand").distinct(), ["Chr", "Strand"], "left_semi")
    return t.join(s, ["Chr", "Strand", "query_tss"], "full").select(*transcripts.columns, "tss_15", "tss_50")


def shift_and_sum(transcripts: DataFrame, least: float = 0.02, first_by: Sequence[str] = ()) -> DataFrame:
    """Transcripts whose starts are moved to their peak (``shift_starts``), those with equal chain and ends
    summed up.

    frequency is the sum; of every other column the value of the row that comes first by
    ``first_by``, then by its ends before the move and its other columns, nulls first, so that
    the outcome does not hang on the order of rows. Rows without chain or ends are left out;
    an empty table stays empty.
    """
    names = transcripts.columns
    rest = [c for c in names if c not in [*ENDS, "frequency"]]
    order = F.struct(*[F.col(c).alias(f"by{i}") for i, c in enumerate([*first_by, "TrStart", "TrEnd"])], F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"))
    before = transcripts.select(*ENDS, "frequency", "tss_offset", "tss_height", order.alias("first"))
    moved = shift_starts(before, least).where(" and ".join(f"{c} is not null" for c in ENDS))
    out = moved.groupBy(*ENDS).agg(F.sum("frequency").alias("frequency"), F.min("first").alias("first"))
    return out.select(*[F.col("first")["rest"].getField(c).alias(c) if c in rest else F.col(c) for c in names])


def best_frames(frames: DataFrame) -> DataFrame:
    """The frame of each transcript (chain and ends) whose start scores highest; of equal ones that whose
    stop does, and then the one with the smaller places."""
    order = F.struct(-F.col("TIS_score"), -F.col("TTS_score"), "TIS_related_location", "TTS_related_location")
    best = frames.groupBy(*ENDS).agg(F.min_by(F.struct(*FRAME), order).alias("f"))
    return best.select(*ENDS, *[f"f.{c}" for c in FRAME])


def with_frames(transcripts: DataFrame, frames: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Transcripts with the places and scores of their best frame and Predict_NMD, once each.

    Columns of these names that are there already are taken out. Transcripts without a frame
    keep null there and are no_orf. No frames at all leave every transcript so.
    """
    own = transcripts.drop(*FRAME, "Predict_NMD")
    out = own.join(best_frames(frames), ENDS, "left").select(*own.columns, *FRAME)
    ex = chain.exons(F.col("TrStart"), chain.sites(F.col("SSC")), F.col("TrEnd"))
    status = chain.nmd(ex, F.col("Strand"), F.col("TIS_score"), F.col("TTS_score"), F.col("TTS_related_location"), threshold)
    return out.withColumn("Predict_NMD", status)


def spelled(table: DataFrame, columns: Sequence[str] = FRAME, none: str = "no") -> DataFrame:
    """Columns as text, with ``none`` where they are null: how reports write values that were not found."""
    return table.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(none)) for c in columns if c in table.columns})
