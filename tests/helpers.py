"""Helpers of the test modules."""

import contextlib
import io
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def write_text(path, text, newline="\n"):
    with open(path, "w", newline="") as fh:
        fh.write(text.replace("\n", newline))
    return path


def plan_text(df) -> str:
    """The physical plan as ``DataFrame.explain`` prints it (public API)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()
