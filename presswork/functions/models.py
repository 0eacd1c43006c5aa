"""Plug-in point for models: batches in, batches out, one failure per row."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Called once per task; returns the function that maps a list of texts.
Loader = Callable[[], Callable[[list[str]], list[Any]]]


def attempt(model: Callable[[list[str]], list[Any]], texts: list[str], batch: int) -> tuple[list[Any], list[str | None]]:
    """Results of a model and, where there is none, the reason.

    The model sees lists of at most ``batch`` texts. When a list fails its texts are tried
    one by one, so that a bad record costs only itself.
    """
    values: list[Any] = []
    errors: list[str | None] = []
    for start in range(0, len(texts), batch):
        some = texts[start : start + batch]
        try:
            found = list(model(some))
            if len(found) != len(some):
                raise ValueError("one result per text is expected")
            values += found
            errors += [None if x is not None else "no result" for x in found]
        except Exception as error:
            if len(some) > 1:
                one_by_one = [attempt(model, [t], 1) for t in some]
                values += [v for vs, _ in one_by_one for v in vs]
                errors += [e for _, es in one_by_one for e in es]
            else:
                values.append(None)
                errors.append(f"{type(error).__name__}: {error}")
    return values, errors


def try_model(text: Column, load: Loader, returns: DataType | str, batch: int = 256) -> Column:
    """Struct of a model's ``value`` over a text column and, where it fails, the ``error``.

    The model is loaded in the task that uses it, not on the driver.
    """
    kind = returns if isinstance(returns, str) else returns.simpleString()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for series in batches:
            values, errors = attempt(model, series.tolist(), batch)
            frame = {"value": pd.Series(values, dtype=object), "error": pd.Series(errors, dtype=object)}
            yield pd.DataFrame(frame)

    return F.pandas_udf(run, f"struct<value:{kind},error:string>")(text)


def apply_model(text: Column, load: Loader, returns: DataType | str, batch: int = 256) -> Column:
    """Results of a model over a text column, null where it fails."""
    return try_model(text, load, returns, batch)["value"]


def try_models(
    text: Column, choice: Column, loaders: dict[str, Loader], returns: DataType | str, batch: int = 256
) -> Column:
    """As ``try_model``, each text by the model that ``choice`` names; null where it names none.

    A task loads a model when it first meets a text for it.
    """
    kind = returns if isinstance(returns, str) else returns.simpleString()

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        loaded: dict[str, Any] = {}
        for texts, names in batches:
            values = pd.Series([None] * len(texts), dtype=object)
            errors = values.copy()
            names = names.reset_index(drop=True)
            for name in [n for n in names.dropna().unique() if n in loaders]:
                at = [i for i in names.index[names == name] if texts.iloc[i] is not None]
                if name not in loaded:
                    loaded[name] = loaders[name]()
                found = attempt(loaded[name], [texts.iloc[i] for i in at], batch)
                for i, value, error in zip(at, *found, strict=True):
                    values[i], errors[i] = value, error
            yield pd.DataFrame({"value": values, "error": errors})

    return F.pandas_udf(run, f"struct<value:{kind},error:string>")(text, choice)
