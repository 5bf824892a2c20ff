"""What several test modules use; not in conftest, as another folder has one of that name."""


def rows(df, *cols):
    """All rows as a sorted list of tuples."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def final_plan(df) -> str:
    """The physical plan after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
