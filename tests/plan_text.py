"""Physical plans as text, for tests of their shape."""


def plan_of(df):
    """The physical plan before adaptive execution, as text."""
    return df._jdf.queryExecution().executedPlan().toString()
