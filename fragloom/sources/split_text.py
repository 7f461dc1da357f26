"""Rows of one byte range of a fragment file, as pandas frames."""

import io
import sys

import pandas as pd
from pyspark import cloudpickle

from fragloom.sources import bgzf
from fragloom.sources.bgzf import is_blocked, split_text, stream_text

# The block reader travels inside the task, executors need no copy of this package.
cloudpickle.register_pickle_by_value(bgzf)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BGZ_SPLIT = 32 << 20
FIELDS = ["chrom", "start", "end", "mapq", "strand"]
KINDS = {"chrom": str, "start": "int64", "end": "int64", "mapq": "int64", "strand": str}


def frames(path: str, length: int, start: int, split_bytes: int):
    """Raw fragments and `path` of the lines that begin in a byte range; a file without blocks
    belongs to its first range. A line with a missing field or a bad number fails."""
    if is_blocked(path):
        pieces = split_text(path, start, start + split_bytes, length)
    elif start:
        return
    else:
        pieces = stream_text(path)
    for piece in pieces:
        if piece.strip():
            frame = pd.read_csv(io.BytesIO(piece), sep="\t", header=None, names=FIELDS, usecols=range(5),
                                dtype=KINDS, keep_default_na=False, quoting=3)
            frame["path"] = path
            yield frame
