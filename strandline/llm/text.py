"""Text helpers shared by the operators of this subpackage (plain Python, run on executors)."""

import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
#: Lower-cases A-Z and leaves every other byte alone.
ASCII_LOWER = bytes.maketrans(UPPER, LOWER)
#: Bytes of a batch that are turned into Python objects at once (at least one row).
SLICE_BYTES = 1 << 20


def slices(batch: pa.RecordBatch | pa.Array) -> Iterator[pa.RecordBatch | pa.Array]:
    """A batch in parts of about ``SLICE_BYTES``."""
    rows = max(1, int(len(batch) * SLICE_BYTES / max(batch.nbytes, 1)))
    for start in range(0, len(batch), rows):
        yield batch.slice(start, rows)


def held(kind: str, key: str, make: Callable[[], object]):
    """What ``make`` gives, kept by the Python worker for its next tasks; it keeps the latest one of each kind."""
    # functions travel by value, so a variable of this module would be new in every task
    store = vars(sys).setdefault("_strandline_held", {})
    if store.get(kind, ("",))[0] != key:
        store.pop(kind, None)
        store[kind] = key, make()
    return store[kind][1]


def type_of(df: DataFrame, column: str) -> str:
    """The type of a column as schemas are written."""
    return df.select(column).schema[0].dataType.simpleString()


def free_name(df: DataFrame, name: str) -> str:
    """A name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable]], schema: str) -> DataFrame:
    """``mapInArrow`` with a worker that is made once per task; it turns a batch into columns of ``schema``."""
    arrow = _arrow_schema(df, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = make()
        for batch in (part for whole in batches for part in slices(whole)):
            columns = worker(batch)
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
            )

    return df.mapInArrow(run, schema)


def text_column(column: Column, make: Callable[[], Callable[[str | None], object]], kind: str) -> Column:
    """A column of type ``kind`` from texts, by a worker that is made once per task; only the texts go to Python.

    It is marked as not deterministic, or the optimizer would call it for a filter and again for a column.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_type(_parse_datatype_string(kind))

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for batch in batches:
            # a part at a time, so that a worker holds one batch of texts and not their results as well
            for part in slices(batch):
                yield pa.array([work(t) for t in part.to_pylist()], arrow)

    return run.asNondeterministic()(column.cast("string"))


def _arrow_schema(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def encoded(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")
