import pytest


@pytest.fixture(scope="session")
def tokenizer():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
