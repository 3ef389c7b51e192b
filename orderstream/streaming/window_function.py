"""A function over all rows of a window: for results that no aggregate of columns expresses.

Rows collect in the state store as one list for each (key, window), by Spark's own streaming aggregate, so that no key costs
calls between the state store and a Python worker. When the watermark passes the window's end, the list leaves the store
and the function is called once with the key, the window's bounds and the rows; what it returns is the
result. A row whose window has closed is late and dropped. A window's rows have to fit
a Python worker, as a function over all of them needs; where an aggregate does, ``operators.windows.windowed_stats``
keeps two numbers instead. A batch writes the lists anew that it adds to.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: (key values, window start, window end, rows) -> rows of the result.
WindowFunction = Callable[[tuple, pd.Timestamp, pd.Timestamp, pd.DataFrame], pd.DataFrame]
#: So many windows go to a Python worker at a time.
WINDOWS = 1000


def _naive(column: pa.ChunkedArray) -> pa.ChunkedArray:
    return column.cast(pa.timestamp("us")) if pa.types.is_timestamp(column.type) else column


def _frame(table: pa.Table) -> pd.DataFrame:
    """The columns as pandas has them, with null text as None and times without zone (UTC)."""
    made = {name: _naive(column).to_pandas() for name, column in zip(table.column_names, table.columns)}
    text = {name for name, column in zip(table.column_names, table.columns) if pa.types.is_string(column.type) or pa.types.is_large_string(column.type)}
    return pd.DataFrame({name: pd.Series(table.column(name).to_pylist(), dtype=object) if name in text else c for name, c in made.items()})


def _calls(fn: WindowFunction, key: Sequence[str], columns: Sequence[str], out: pa.Schema):
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, WINDOWS):
                batch = whole.slice(at, WINDOWS)
                lists = batch.column("rows")
                ends = [0, *pc.cumulative_sum(pc.list_value_length(lists)).to_pylist()]
                rows = _frame(pa.Table.from_batches([pa.RecordBatch.from_struct_array(lists.flatten())]).select(list(columns)))
                keys = zip(*[batch.column(k).to_pylist() for k in key]) if key else iter([()] * batch.num_rows)
                bounds = _frame(pa.Table.from_batches([batch.select(["window_start", "window_end"])]))
                made = [fn(k, start, end, rows.iloc[a:b].reset_index(drop=True))
                        for k, start, end, a, b in zip(keys, bounds["window_start"], bounds["window_end"], ends, ends[1:])]
                yield from pa.Table.from_pandas(pd.concat(made, ignore_index=True), schema=out, preserve_index=False).to_batches()

    return run


def window_apply(events: DataFrame, key: Sequence[str], columns: Sequence[str], fn: WindowFunction, schema: str, *, width_s: int = 60,
                 event_time: str = "event_time") -> DataFrame:
    """``fn`` over the ``columns`` of each tumbling window's rows; ``events`` is a stream with a watermark on ``event_time``."""
    lists = (events.groupBy(*key, F.window(event_time, f"{width_s} seconds").alias("window"))
             .agg(F.collect_list(F.struct(*columns)).alias("rows"))
             .select(*key, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "rows"))
    out = to_arrow_schema(T.StructType.fromDDL(schema))
    return lists.mapInArrow(_calls(fn, key, columns, out), schema)
