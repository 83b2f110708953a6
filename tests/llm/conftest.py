import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


@pytest.fixture
def docs(rows):
    """Documents from (doc_id, text) or longer tuples, missing columns NULL."""
    return lambda *data: rows([tuple(d) + (None,) * (6 - len(d)) for d in data], DOCS)
