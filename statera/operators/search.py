"""Text search over several columns."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TERM = re.compile(r'"([^"]+)"|([^\s,]+)')


def search(df: DataFrame, text: str, fields: Sequence[str]) -> DataFrame:
    """Rows where every term occurs in at least one field, whatever the case.

    Terms are separated by white space or commas; double quotes hold a phrase together.
    """
    terms = [(quoted or plain).lower() for quoted, plain in TERM.findall(text)]
    for term in terms:
        hits = [F.lower(F.col(name)).contains(F.lit(term)) for name in fields]
        df = df.filter(reduce(lambda a, b: a | b, hits))
    return df
