"""Isoform analytics on Spark: reads to chains, loci, transcripts and counts, as DataFrame transforms."""
