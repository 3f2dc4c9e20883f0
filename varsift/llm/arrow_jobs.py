"""The two shapes of a per-document Arrow job: a report (one row out per row in) and a row filter."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from varsift.llm.text_arrays import chunks

#: From (bytes, offsets) of a chunk of texts to one array per output column.
Scorer = Callable[[np.ndarray, np.ndarray], list]


def report(docs: DataFrame, scorer: Callable[[], Scorer], fields: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its id, then ``fields`` (DDL) as the scorer gives them for the text.

    ``scorer`` is called once in each task (to compile tables there). Rows with a null id keep it; a null text
    is an empty text; repeated rows give repeated results; columns of ``docs`` besides these two are not read.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = StructType.fromDDL(fields)
    out = to_arrow_schema(schema)
    out_all = StructType([rows.schema["_id"], *schema.fields])
    id_type = to_arrow_schema(StructType([rows.schema["_id"]])).field(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer()
        whole = pa.schema([id_type, *out])
        for batch in batches:
            for at, data, offsets in chunks(batch, "_text"):
                ids = batch.column(0).slice(at.start, at.stop - at.start)
                got = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, f.type)
                       for x, f in zip(score(data, offsets), out, strict=True)]
                yield pa.RecordBatch.from_arrays([ids, *got], schema=whole)

    return rows.mapInArrow(run, out_all).withColumnRenamed("_id", id_col)


def keep_rows(docs: DataFrame, decide: Callable[[], Callable[[np.ndarray, np.ndarray], np.ndarray]],
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, for which the decision on the text is true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = decide()
        for batch in batches:
            for at, data, offsets in chunks(batch, text_col):
                yield batch.slice(at.start, at.stop - at.start).filter(pa.array(keep(data, offsets)))

    return docs.mapInArrow(run, docs.schema)


def strings(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The texts of a chunk as Python strings."""
    whole = data.tobytes()
    return [whole[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
