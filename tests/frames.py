"""Reading of small results."""


def rows_of(frame, *columns):
    """Sorted tuples of a frame, nulls first."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, v) for v in t])
