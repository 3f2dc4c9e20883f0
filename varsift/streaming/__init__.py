"""Incremental carrier search: the genotype side of the filter as a Structured Streaming query.

The original job is batch-only. Genotype files of a study arrive over time; here the flagged
variants and the clinical lists are computed once (batch, bounded, cached) and every new genotype
file is filtered and joined as it lands (stream-static joins), with progress kept in the checkpoint
folder so a restarted query neither repeats nor skips files.
"""

from varsift.streaming.carriers import CarrierStream, start_carrier_stream

__all__ = ["CarrierStream", "start_carrier_stream"]
