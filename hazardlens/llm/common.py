"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

SPACES = " \t\n\x0b\x0c\r"
#: Characters of input that are worked on at a time; bounds memory only.
CHUNK = 500_000
#: What of a table goes to Python at a time unless the session says so; bounds memory only.
SENT, _SENT_KEY = "4m", "spark.sql.execution.arrow.maxBytesPerBatch"


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without the columns an operator is about to add, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def packed(df: DataFrame, *needed: str | Column) -> DataFrame:
    """All columns of ``df`` as the struct ``row``, beside the ``needed`` ones, so that no name of an
    operator can clash with one of the table; ``select("row.*")`` gives the table back."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *needed)


def whole_text(name: str = "text") -> Column:
    """The text as it is; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def add_columns(
    df: DataFrame,
    inputs: list[str],
    fields: list[StructField],
    make: Callable[[], Callable[..., list]],
) -> DataFrame:
    """``df`` with columns computed from one row at a time.

    ``make`` runs once per task and returns a function from the ``inputs`` of a row to the
    values of ``fields``. Columns of those names are replaced.
    """

    def make_rows():
        call = make()
        return lambda *columns: zip(*[call(*row) for row in zip(*columns, strict=True)], strict=True)

    return add_columns_by_chunk(df, inputs, fields, make_rows)


def add_columns_by_chunk(
    df: DataFrame,
    inputs: list[str],
    fields: list[StructField],
    make: Callable[[], Callable[..., Iterable[list]]],
    chunk: int = CHUNK,
) -> DataFrame:
    """Like ``add_columns``, with a function from lists of values to one list per field.

    It gets rows of about ``chunk`` characters at a time, one row at least, so a task holds
    one Arrow batch of input and what it makes of a few million characters. The session's Arrow
    batches hold ``SENT`` bytes from then on, if it has set no size itself: both sides keep whole
    batches in memory.
    """
    if _SENT_KEY not in df.sparkSession.conf.getAll:
        df.sparkSession.conf.set(_SENT_KEY, SENT)
    names = [f.name for f in fields]
    if {n.lower() for n in inputs} & {n.lower() for n in names}:
        raise ValueError("inputs and results must not share names")
    kept = without(df, names)
    schema = StructType([*kept.schema.fields, *fields])
    types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(n)) for n in inputs]
            start, size, rows = 0, 0, []
            for i in range(batch.num_rows):
                rows.append([c[i].as_py() for c in columns])
                size += sum(len(v) for v in rows[-1] if isinstance(v, (str, bytes)))
                if size > chunk or i + 1 == batch.num_rows:
                    values = call(*map(list, zip(*rows, strict=True)))
                    made = [pa.array(list(v), t) for v, t in zip(values, types, strict=True)]
                    part = batch.slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, *made], names=[*batch.schema.names, *names]
                    )
                    start, size, rows = i + 1, 0, []

    return kept.mapInArrow(run, schema)
