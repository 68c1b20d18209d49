"""Python text functions as Arrow-batched columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string  # noqa: PLC2701


def text_column(fn: Callable[..., object], kind: str, *columns: Column, faults: bool = False) -> Column:
    """``fn`` applied to the values of ``columns``; a null in the first one gives null.

    A row on which ``fn`` raises gives null: one malformed text does not fail a job. With ``faults`` the column is
    struct(value, fault), and ``fault`` says what was raised; as more than one field of it is used, it counts as not
    deterministic: else a filter on one field is moved below the others, and ``fn`` runs over each row twice.
    """
    from pyspark.sql import SparkSession

    kind = f"struct<value:{kind},fault:string>" if faults else kind
    arrow = to_arrow_type(_parse_datatype_string(kind)) if SparkSession.getActiveSession() else None

    def one(args: tuple) -> object:
        value = fault = None
        if args[0] is not None:
            try:
                value = fn(*args)
            except Exception as e:  # noqa: BLE001  whatever a text sets off is that text's fault
                fault = f"{type(e).__name__}: {e}"[:500]
        return {"value": value, "fault": fault} if faults else value

    @F.arrow_udf(kind)
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            batch = batch if isinstance(batch, tuple) else (batch,)
            yield pa.array(map(one, zip(*(c.to_pylist() for c in batch))), arrow)

    @F.arrow_udf(kind)
    def run_one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((one((v,)) for v in batch.to_pylist()), arrow)

    made = run if len(columns) > 1 else run_one
    return (made.asNondeterministic() if faults else made)(*columns)
