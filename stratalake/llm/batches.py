"""Arrow-batch functions over documents that carry all other columns along untouched."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.words import slices


def appended(docs: DataFrame, inputs: dict[str, object], fields: str, work: Callable[[], Callable[[pa.RecordBatch], list]], text: str) -> DataFrame:
    """One column ``row`` (a struct of all columns of ``docs``), then the columns that ``work`` makes.

    ``inputs`` names the columns that the function sees (expressions over ``docs``), so columns of
    ``docs`` may have any names. ``work()`` is called once per task and returns the function; it gets
    batches of a bounded number of bytes of the input ``text`` and returns one sequence per field.
    """
    made = T._parse_datatype_string(fields)
    schema = T.StructType([T.StructField("row", docs.schema), *made.fields])
    types = [pa.field(f.name, to_arrow(f.dataType)) for f in made.fields]
    names = list(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = work()
        for batch in batches:
            for part in slices(batch, text):
                columns = fn(part.select(names))
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], ["row", *(f.name for f in types)])

    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    seen = [(docs[f"`{v}`"] if isinstance(v, str) else v).alias(k) for k, v in inputs.items()]
    return docs.select(whole, *seen).mapInArrow(run, schema)


def to_arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
