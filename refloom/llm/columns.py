"""Names of columns that an operator adds for a while."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores after it until no column of df is called so, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
