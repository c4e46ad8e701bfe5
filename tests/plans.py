"""Reading physical plans in tests."""

import contextlib
import io
import re


def plan_of(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def scans(plan):
    """How many Parquet scans a formatted plan has."""
    return len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M))


def line_of(plan, start):
    """The rest of each line of a formatted plan that begins with ``start``."""
    return re.findall(rf"^{re.escape(start)}\s*(.*)$", plan, re.M)
