"""User-supplied calculators, models and filters."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

Filter = Callable[[DataFrame, dict], DataFrame]

_REGISTRY: dict[str, Filter] = {}

# Of the batches that a calculator gets: bytes of their rows and rows at most (a longer row is alone).
BATCH_BYTES = 4_000_000
BATCH_ROWS = 1_000


def register(name: str, fn: Filter) -> None:
    _REGISTRY[name] = fn


def filter_named(name: str) -> Filter:
    if name not in _REGISTRY:
        raise ValueError(f"Filter {name} not found")
    return _REGISTRY[name]


def with_calculator(
    df: DataFrame,
    calculate: Callable[[Any, pd.DataFrame], pd.DataFrame],
    schema: str,
    start: Callable[[], Any] | None = None,
    inputs: list[str] | None = None,
    error: str | None = None,
) -> DataFrame:
    """Append columns computed batch-wise in Python.

    A calculator gets up to ``BATCH_ROWS`` rows and ``BATCH_BYTES`` at once; only the ``inputs`` become a frame, the other
    columns stay as Spark sent them.
    ``start`` runs once per task (compile rules, load a model); ``calculate(state, batch)`` returns a
    frame with the columns of ``schema``.  If a batch raises, its rows are tried one by one, and a row
    that still raises gets NULLs; what NULL means is up to ``fail_policy``.  ``error`` names a column for
    the message of a row that raised, so that a calculator that always fails does not go unseen.
    """
    added = T._parse_datatype_string(schema)
    names = [f.name for f in added]
    told = [T.StructField(error, T.StringType())] if error else []
    out_schema = T.StructType([*df.schema.fields, *added.fields, *told])

    to_add = to_arrow_schema(T.StructType([*added.fields, *told]))

    def calculated(state: Any, seen: pd.DataFrame) -> pd.DataFrame:
        try:
            extra = calculate(state, seen)[names].reset_index(drop=True)
            if error:
                extra[error] = None
            return extra
        except Exception:  # noqa: BLE001
            rows = []
            for i in range(len(seen)):
                try:
                    rows.append(calculate(state, seen.iloc[[i]])[names].iloc[0].to_dict())
                except Exception as raised:  # noqa: BLE001
                    rows.append(dict.fromkeys(names) | ({error: f"{type(raised).__name__}: {raised}"} if error else {}))
            return pd.DataFrame(rows, columns=[*names, *([error] if error else [])]).astype(object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start() if start else None
        for batch in batches:
            for part in _parts(batch):
                extra = calculated(state, _frame(part.select(inputs) if inputs else part))
                columns = [pa.Array.from_pandas(extra[f.name], type=f.type, safe=False) for f in to_add]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *to_add.names])

    return df.mapInArrow(run, out_schema)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Halves of a batch, and halves of these, until they are small enough."""
    if batch.num_rows > 1 and (batch.num_rows > BATCH_ROWS or batch.nbytes > BATCH_BYTES):
        half = batch.num_rows // 2
        yield from _parts(batch.slice(0, half))
        yield from _parts(batch.slice(half))
    else:
        yield batch


def _frame(rows: pa.RecordBatch) -> pd.DataFrame:
    """Rows as Spark gives them to pandas functions: times of the session without a zone, maps as dicts."""
    out = rows.to_pandas(date_as_object=True, coerce_temporal_nanoseconds=True, maps_as_pydicts="lossy")
    for name in out.columns:
        if isinstance(out[name].dtype, pd.DatetimeTZDtype):
            out[name] = out[name].dt.tz_localize(None)
    return out


def with_model_score(df: DataFrame, counts: str, predict: Callable[[np.ndarray], np.ndarray] | None, out: str = "model_score") -> DataFrame:
    """Score count vectors in batches; rows without a vector get NULL, without a model all do.

    ``predict`` travels with the job once per executor; Spark broadcasts it when it is large.
    """
    if predict is None:
        return df.withColumn(out, F.lit(None).cast("double"))

    @F.pandas_udf("double")
    def score(vectors: pd.Series) -> pd.Series:
        usable = vectors.notna()
        result = np.full(len(vectors), np.nan)
        if usable.any():
            result[usable.to_numpy()] = predict(np.stack(vectors[usable].to_list()).astype(float))
        return pd.Series(result)

    return df.withColumn("__s", score(counts)).withColumn(out, F.when(~F.isnan("__s"), F.col("__s"))).drop("__s")


def flag_of(value: Column, test: Column) -> Column:
    return F.when(value.isNotNull(), test)
