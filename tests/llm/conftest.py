from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from texts or (text, lang, source), numbered from 0 unless an id is given as a fourth value."""
    def make(*rows):
        full = [r if isinstance(r, tuple) else (r,) for r in rows]
        table = []
        for i, r in enumerate(full):
            text, lang, source = (*r[:3], None, None)[:3]
            table.append((r[3] if len(r) > 3 else i, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(table, DOCS)

    return make
