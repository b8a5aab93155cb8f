import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture(scope="session")
def tokenizer_file():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls, repeated rows and ids, empty and long texts, ties, and columns with clashing names."""
    long = " ".join(f"word{i % 977} og{i}" for i in range(30_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog " * 4, "en", "a"), (1, "the quick brown fox jumps over the lazy dog " * 4, "en", "a"),
        (None, "le chat est sur la table avec les autres chats de la maison et il dort", "fr", None), (3, None, None, "a"), (4, "", "en", "b"), (5, " \n\t ", None, "b"),
        (6, long, "en", "a"), (7, long + " tail", None, "a"), (8, "eins zwei", "de", "b"), (9, "eins zwei", "de", "b"), (10, "\U0001F600 é 日本 <|endoftext|> it's", "en", "b"), (None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    extra = {"n_chars": "bigint(length(text))", "id": "'x'", "node": "1", "n": "2", "host": "'h'", "text_key": "'k'", "row": "3", "shard": "'s'", "slot": "1", "pii": "'p'", "size": "9", "grp": "1", "limited": "1", "lines": "'l'", "held_out": "'no'", "score": "'z'"}
    return df.selectExpr("*", *(f"{v} AS {k}" for k, v in extra.items()))


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.where("1 = 0")
