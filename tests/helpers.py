"""What several test modules use."""

DATA = "/root/testdata/sf0.001"


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
