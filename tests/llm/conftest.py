from __future__ import annotations

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture()
def make_docs(spark):
    """Documents from texts (or (doc_id, text) or (doc_id, text, source) tuples)."""

    def made(rows, extra=""):
        out = []
        for i, r in enumerate(rows):
            r = r if isinstance(r, tuple) else (i, r)
            text = r[1]
            out.append((r[0], text, None, r[2] if len(r) > 2 else "s", None if text is None else len(text))
                       + (("x",) * len(extra.split(",")) if extra else ()))
        schema = DOC_SCHEMA + "".join(f", {c.strip()} string" for c in extra.split(",") if extra)
        return spark.createDataFrame(out, schema)

    return made
