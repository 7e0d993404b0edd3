"""What the tests share besides fixtures. No test module imports from a conftest: their names may clash."""

from ledgerflow.operators.scd2 import build, versioned
from ledgerflow.operators.sequence import latest_per_key

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


def rows(df, *cols):
    """Sorted list of tuples (order-insensitive comparisons)."""
    cols = cols or df.columns
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def closed_form(versions, key, version, batch_col, tie, whole_first=False):
    """What batches applied one after another in ``latest`` mode leave, as one query: the newest row per (key, batch),
    chained by version; with ``whole_first`` the first batch (0) is a history and keeps every row."""
    keyed = versioned(versions, key, version)
    later = latest_per_key(keyed.where(f"{batch_col} > 0") if whole_first else keyed, [key, batch_col], [version, tie])
    both = keyed.where(f"{batch_col} = 0").unionByName(later) if whole_first else later
    return build(both.drop(batch_col), key, version, tie)
