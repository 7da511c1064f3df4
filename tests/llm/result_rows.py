"""Results as comparable rows."""


def by_row(result, *names):
    """Result rows as a sorted list of tuples, doc_id first."""
    return sorted(
        (tuple(row[name] for name in ("doc_id", *names)) for row in result.collect()), key=repr
    )
