from collections import Counter


def bag(df):
    return Counter(tuple(row) for row in df.collect())


def executed_plan(df):
    """The plan as it ran, after adaptive execution has settled it."""
    df.toArrow()
    return df._jdf.queryExecution().executedPlan().toString()


def planned(df):
    """The physical plan before anything runs."""
    return df._jdf.queryExecution().executedPlan().toString()
