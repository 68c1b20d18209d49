"""Records into output shards of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEBIBYTE = 1024 * 1024


def _json(names: tuple[str, ...], opening: str, between: str, closing: str) -> Column:
    parts: list[Column] = []
    for k, name in enumerate(names):
        value = F.substring(F.to_json(F.struct(F.col(name).alias("v")), {"ignoreNullFields": "false"}), 6, 1 << 30)
        parts += [F.lit((between if k else opening) + f'"{name}": '), F.substring(value, F.lit(1), F.length(value) - 1)]
    return F.concat(*parts, F.lit(closing))


def json_line(*names: str) -> Column:
    """A record as one JSON line, nulls written, with ``", "`` and ``": "`` between items."""
    return _json(names, "{", ", ", "}")


def json_item(*names: str) -> Column:
    """A record as an item of an array that is indented by two blanks."""
    return _json(names, "  {\n    ", ",\n    ", "\n  }")


def assign_parts(rows: DataFrame, order: list[str], size: str, most: int, overhead: int = 0, close_after: bool = False) -> DataFrame:
    """``rows`` with ``part_no`` from 1, by greedy packing in ``order``.

    A part closes before a row that would take it past ``most`` bytes (each row counting ``overhead``
    more), or with ``close_after`` once it has reached ``most``. The fold is sequential, so only order
    keys and sizes pass through its one task; rows get their numbers back by a join on the order keys,
    which must be unique.
    """
    narrow = rows.select(*order, F.col(size).cast("bigint").alias("__size")).repartition(1).sortWithinPartitions(*order)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, some = 1, 0, False
        for batch in batches:
            numbers = []
            for item in batch["__size"].tolist():
                if not close_after and some and held + item + overhead > most:
                    part, held = part + 1, 0
                numbers.append(part)
                held, some = held + item, True
                if close_after and held >= most:
                    part, held = part + 1, 0
            yield batch[order].assign(part_no=numbers)

    kinds = dict(narrow.dtypes)
    numbered = narrow.mapInPandas(pack, ", ".join([f"`{c}` {kinds[c]}" for c in order] + ["part_no bigint"]))
    return rows.join(numbered, order)


def approximate_parts(rows: DataFrame, size: str, most: int) -> DataFrame:
    """``part_no`` without a sequential pass: each input partition packs its own rows, so parts number by
    partition and none passes ``most`` but for a single larger row."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        base, part, held = TaskContext.get().partitionId() << 20, 0, 0
        for batch in batches:
            numbers = []
            for item in batch[size].tolist():
                if held and held + item > most:
                    part, held = part + 1, 0
                numbers.append(base + part)
                held += item
            yield batch.assign(part_no=numbers)

    return rows.mapInPandas(pack, ", ".join([f"`{c}` {t}" for c, t in rows.dtypes] + ["part_no bigint"]))
