"""Stream-static form of J7 + J10-J12 over a directory of arriving genotype files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from varsift.operators import clinical as C
from varsift.operators.annotations import GeneSet
from varsift.params import FilterParams
from varsift.plans.gene_filter import AnnotationPlan, VariantTables, attach_carriers, measured_flagged, plan_annotations


@dataclass
class CarrierStream:
    """The streaming result plus the batch plan whose cached parts it reads."""

    result: DataFrame
    batch_plan: AnnotationPlan
    static_frames: list[DataFrame]

    def release(self) -> None:
        for df in self.static_frames:
            df.unpersist()
        self.batch_plan.release()


def carrier_stream(spark: SparkSession, tables: VariantTables, genes: Sequence[str] | DataFrame | GeneSet,
                   studies: Sequence[str], occurrences_dir: str, occurrences_schema: StructType,
                   params: FilterParams = FilterParams(), max_files_per_trigger: int | None = None) -> CarrierStream:
    """Streaming result rows for genotype files landing in ``occurrences_dir``.

    ``tables.occurrences`` is not read; the annotation side runs once as a batch plan (its
    flagged rows are measured and cached, so the per-batch join is a broadcast join when small),
    and the per-participant lists are aggregated once and cached for the life of the stream.
    """
    batch = plan_annotations(tables, genes, studies, params)
    flagged, measured = measured_flagged(batch, params)
    prof = params.profile
    lists = C.clinical_lists(tables.diagnoses, tables.phenotypes,
                             tables.studies if prof.has_studies_table else None, prof.clinical_layout)
    lists = tuple(df.persist(StorageLevel.MEMORY_AND_DISK) if df is not None else None for df in lists)
    reader = spark.readStream.schema(occurrences_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    occurrences = reader.parquet(occurrences_dir)
    _, result = attach_carriers(batch.on_gene_chromosomes(occurrences), flagged, tables, params, measured,
                                batch.measured_consequences, lists=lists, measured_out=batch.measured)
    return CarrierStream(result, batch, [df for df in lists if df is not None])


def start_carrier_stream(stream: CarrierStream, output_dir: str, checkpoint_location: str,
                         available_now: bool = True, query_name: str = "varsift_carriers") -> StreamingQuery:
    """Append the stream's rows as Parquet under ``output_dir``.

    ``checkpoint_location`` holds the stream's progress: a shared folder of its own for each stream, the same
    one again on a restart. ``available_now`` processes what has landed and stops; otherwise the query runs
    until stopped.
    """
    writer = (stream.result.writeStream.format("parquet").outputMode("append").queryName(query_name)
              .option("checkpointLocation", checkpoint_location).option("path", output_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
