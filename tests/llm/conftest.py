import public_tokenizers
import pytest
from tokenizers import Tokenizer

#: Texts every operator has to live with.
ODD = [None, "", " ", "\n\n\t", "a", "word", "Ünïcode ß — 語 テスト 🎉", "x" * 30_000, "la la la " * 5_000, "<|endoftext|> it's\r\n\x1c  end"]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Odd texts, repeated rows, NULL ids, and extra columns with clashing names."""
    rows = [(i, t, "en", "src", 1, 7) for i, t in enumerate(ODD)] + [(3, ODD[3], "en", "src", 1, 7), (4, "other", None, None, None, None), (None, "no id", None, None, None, 7), (None, None, None, None, None, 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, length long")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def ids_of():
    """Ids by the library itself, by tokenizer file name."""
    def load(name):
        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        tokenizer.encode_special_tokens = True
        return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids
    return load
