"""What tests look at in a frame."""


def values(frame, *columns):
    """Rows as a sorted list of tuples."""
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def physical_plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
