import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent.parent
for place in (ROOT, ROOT / "tests"):
    if str(place) not in sys.path:
        sys.path.insert(0, str(place))

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "_id string, _row string, _doc string, stratum string, good string, spans string, size string")


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text[, source[, lang]]), with more columns whose names clash."""
    def make(rows):
        full = []
        for doc_id, text, *more in rows:
            source, lang = (list(more) + ["s", "en"][len(more):])[:2]
            n = None if text is None else len(text)
            full.append((doc_id, text, lang, source, n, "a", "b", "c", "d", "e", "f", "g"))
        return spark.createDataFrame(full, DOCS)

    return make
