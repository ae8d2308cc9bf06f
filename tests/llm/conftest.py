import os
import sys

import pytest

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
# the workers import the operators by name
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents from (doc_id, text) pairs, n_chars and a clashing column added."""
    def make(rows, lang="en", source="s"):
        data = [(i, t, lang, source, None if t is None else len(t), "clash") for i, t in rows]
        return spark.createDataFrame(data, SCHEMA + ", n_words string")
    return make
