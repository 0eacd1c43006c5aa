"""Helpers for pandas frames inside tasks."""

from __future__ import annotations

import pandas as pd


def plain_text(frame: pd.DataFrame) -> pd.DataFrame:
    """The frame with text columns as plain objects.

    Newer pandas keeps text in Arrow arrays, chunked once frames are put together,
    and the conversion back to Spark does not accept chunks.
    """
    text = [c for c in frame.columns if isinstance(frame[c].dtype, pd.StringDtype)]
    return frame.astype({c: object for c in text})
