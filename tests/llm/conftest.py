import pytest


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
