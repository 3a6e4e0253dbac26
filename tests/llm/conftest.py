import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from stratalake.llm.queries import ready  # noqa: E402

#: Names that the operators use for themselves.
CLASHING = ("row", "text_key", "sid", "n", "region", "score", "runs", "items", "hash", "part", "id", "flag", "cuts", "_left", "shard", "pieces")


@pytest.fixture
def table(spark):
    """Documents from (doc_id, text) pairs, with further columns whose names the operators use too."""
    ready(spark)

    def make(rows, key="doc_id", clashing=True, extra=()):
        more = CLASHING if clashing else ()
        schema = f"{key} bigint, text string" + "".join(f", `{c}` string" for c in (*more, *extra))
        return spark.createDataFrame([(i, t, *["x"] * (len(more) + len(extra))) for i, t in rows], schema)

    return make
