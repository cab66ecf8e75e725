"""A user's function between validation and the sink: any number of rows for each message.

The function is a plain Python generator. It is called on the rows of Arrow batches (``mapInArrow``), so that it
works alike on a batch and on a stream, each message by itself. What it yields for a message counts only when it
ends without an exception; otherwise the message gives a single row with the error, which goes to the rejects with
the reason ``processing_error`` (stage ``processing``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.conversion import ArrowTableToRowsConversion, LocalDataToArrowConversion
from pyspark.sql.pandas.types import to_arrow_type

REASON = "processing_error"
ERROR = "hook_error"
BATCH_ROWS = 10_000  # rows that are sent on together, at least those of one message

#: Takes the input columns of a row and yields one tuple per output row.
Hook = Callable[..., Iterable[tuple]]


def _calls(hook: Hook, given: T.StructType, width: int, output: T.StructType):
    """The ``mapInArrow`` function: calls the hook with the columns behind the first ``width`` of every row."""
    names = [*given.names[:width], *output.names, ERROR]
    inputs = T.StructType([T.StructField(f"_{i}", f.dataType, True) for i, f in enumerate(given.fields[width:])])
    yielded = T.StructType([*(T.StructField(f.name, f.dataType, True) for f in output.fields),
                            T.StructField(ERROR, T.StringType(), True)])
    kinds = [to_arrow_type(f.dataType) for f in output.fields]
    failed = (None,) * len(kinds)

    def fits(rows: list[tuple]) -> None:
        for row in rows:
            if len(row) != len(kinds):
                raise ValueError(f"a row of {len(row)} values, {len(kinds)} are declared")
            for value, kind in zip(row, kinds):
                pa.array([value], kind)  # a value of another type is the hook's error, not the query's

    def all_fit(calls: list[tuple[int, list[tuple]]]) -> bool:
        rows = [row for _, made in calls for row in made]
        try:
            for column, kind in zip(zip(*rows, strict=True) if rows else (), kinds, strict=bool(rows)):
                pa.array(column, kind)
        except Exception:  # noqa: BLE001 - found again for its message by ``fits``
            return False
        return True

    def told(e: Exception) -> list[tuple]:
        return [(*failed, f"{type(e).__name__}: {e}")]

    def batch_of(batch: pa.RecordBatch, calls: list[tuple[int, list[tuple]]], errors: dict[int, list[tuple]]) -> Iterator[pa.RecordBatch]:
        checked, at, rows = all_fit(calls), [], []
        for i, made in calls:
            if i in errors:
                out = errors[i]
            else:
                try:
                    if not checked:
                        fits(made)
                    out = [(*row, None) for row in made]
                except Exception as e:  # noqa: BLE001
                    out = told(e)
            at += [i] * len(out)
            rows += out
        if rows:
            kept = batch.take(pa.array(at, pa.int64())).columns[:width]
            made = LocalDataToArrowConversion.convert(rows, yielded, False).combine_chunks()
            yield pa.RecordBatch.from_arrays([*kept, *[c.chunk(0) for c in made.columns]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            args = pa.Table.from_arrays(batch.columns[width:], inputs.names) if len(inputs) else None
            every = ArrowTableToRowsConversion.convert(args, inputs) if len(inputs) else [()] * batch.num_rows
            calls, errors, held = [], {}, 0
            for i, values in enumerate(every):
                try:
                    made = [tuple(row) for row in hook(*values)]
                except Exception as e:  # noqa: BLE001 - whatever the user's function raises belongs to its message
                    made, errors[i] = [], told(e)
                calls.append((i, made))
                held += len(made) + 1
                if held >= BATCH_ROWS:
                    yield from batch_of(batch, calls, errors)
                    calls, errors, held = [], {}, 0
            if calls:
                yield from batch_of(batch, calls, errors)

    return run


def expand(df: DataFrame, hook: Hook, inputs: Sequence[str], output: T.StructType) -> DataFrame:
    """``df``'s columns, the hook's output columns and ``hook_error`` for every row that the hook yields, and
    one with the error for every row of ``df`` on which it fails. Output names must differ from ``df``'s."""
    clash = {f.name for f in output.fields} & set(df.columns)
    if clash:
        raise ValueError(f"output columns are columns of the input already: {sorted(clash)}")
    given = df.select("*", *[F.col(c).alias(f"_hook_input_{i}") for i, c in enumerate(inputs)])
    schema = T.StructType([*df.schema.fields, *(T.StructField(f.name, f.dataType, True) for f in output.fields),
                           T.StructField(ERROR, T.StringType(), True)])
    return given.mapInArrow(_calls(hook, given.schema, len(df.columns), output), schema)


def split(expanded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that the hook yielded, messages on which it failed with ``reject_reason`` and ``hook_error``)."""
    failed = F.col(ERROR).isNotNull()
    return (expanded.where(~failed).drop(ERROR),
            expanded.where(failed).withColumn("reject_reason", F.lit(REASON)))
