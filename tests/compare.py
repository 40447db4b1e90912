"""Row-multiset comparison shared by tests (same rules as tools/oracle_check.py)."""

import datetime as dt
import math
from collections import Counter


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def multiset(rows, cols, order):
    idx = [cols.index(c) for c in order]
    return Counter(tuple(norm(r[i]) for i in idx) for r in rows)


def close_frames(a, b, keys, rtol=1e-9, atol=1e-9):
    """pandas frames equal after sorting by keys, floats within tolerance."""
    import numpy as np
    a = a.sort_values(keys).reset_index(drop=True)
    b = b.sort_values(keys).reset_index(drop=True)
    assert list(a.columns) == list(b.columns), (list(a.columns), list(b.columns))
    assert len(a) == len(b)
    for c in a.columns:
        x, y = a[c], b[c]
        if x.dtype.kind in "fc" or y.dtype.kind in "fc":
            xv, yv = x.astype(float).to_numpy(), y.astype(float).to_numpy()
            assert np.allclose(xv, yv, rtol=rtol, atol=atol, equal_nan=True), c
        else:
            assert (x.astype(object).where(x.notna(), None).tolist()
                    == y.astype(object).where(y.notna(), None).tolist()), c
