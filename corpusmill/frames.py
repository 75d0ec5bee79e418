"""Building the frames that Python stages hand back."""

from __future__ import annotations

import pandas as pd


def frame(data: dict[str, list] | list[tuple], names: list[str] | None = None) -> pd.DataFrame:
    """A frame of columns, or of rows and names. Empty columns are of objects: pandas takes them for numbers, which Arrow cannot turn into text."""
    if isinstance(data, dict):
        return pd.DataFrame({k: pd.Series([], dtype=object) if not len(v) else v for k, v in data.items()})
    return pd.DataFrame(data, columns=names) if data else pd.DataFrame({n: pd.Series([], dtype=object) for n in names or []})
