from datetime import datetime


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def one(df):
    return tuple(df.first())


def ts(text):
    return datetime.fromisoformat(text)


def plan(df):
    """The optimised and physical plan as text."""
    return df._jdf.queryExecution().toString()
