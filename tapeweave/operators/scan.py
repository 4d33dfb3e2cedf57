"""A pass over each key's rows in order that carries state: for recurrences, which windows cannot express."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

_TYPES = {"double": pa.float64(), "boolean": pa.bool_(), "array<double>": pa.list_(pa.float64())}


def scan_by_key(df: DataFrame, key: str, order: list[str], inputs: list[str], start: Callable[[], Callable], outputs: dict[str, str], *, partitioned: bool = False, resume: str | None = None) -> DataFrame:
    """df with `outputs` (name: double, boolean or array<double>), computed row by row in the order given, for each key anew.

    start() gives a function for a key; it is called with the inputs' values of each of its rows and
    returns the outputs' values. With `resume`, a column of states that all rows of a key share, start(state) gives it
    where an earlier pass has stopped. One shuffle on the key; rows stream in Arrow batches, so a key's history
    may be of any length. Windows over the same key before or after share the partitioning.
    """
    names = [*df.columns, *outputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, step = object(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = []
            given = batch.column(resume) if resume else None
            for i, (k, *values) in enumerate(zip(*(batch.column(c).to_pylist() for c in (key, *inputs)), strict=True)):
                if k != current:
                    current, step = k, start(given[i].as_py()) if resume else start()
                rows.append(step(*values))
            added = [pa.array(x, _TYPES[t]) for x, t in zip(zip(*rows, strict=True), outputs.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"`{n}` {t}" for n, t in outputs.items()])
    return (df if partitioned else df.repartition(key)).sortWithinPartitions(key, *order).mapInArrow(run, schema)
