"""How tests look at a DataFrame: its rows, and its plans."""

from __future__ import annotations


def rows(df, *order):
    """The rows of ``df`` as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def plan(df) -> str:
    """The physical plan before it has run."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The physical plan after AQE has run it."""
    df.collect()
    text = plan(df)
    return text.split("== Initial Plan ==")[0]
