"""The bounded samples that models are trained on: what they hold when rows repeat."""

import pytest

from sparkwork.llm import language_id

WORDS = "one two three four five six seven eight nine ten".split()


def numbered(n):
    """``n`` distinct texts of letters only."""
    return [" ".join(WORDS[int(c)] for c in str(10_000 + i)) for i in range(n)]


@pytest.fixture
def dictionaries(spark):
    def made(texts):
        rows = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
        return dict(language_id.train(rows))

    return made


def test_language_sample_is_the_same_with_copies(dictionaries):
    texts = numbered(1000)
    once = dictionaries(texts)["en"]
    assert dictionaries(texts * 5 + texts[:1] * 4000)["en"] == once  # as many distinct texts, none twice
    few = texts[:20]
    assert sorted(dictionaries(few * 200)["en"].split()) == sorted(" ".join(few).encode().split())


def test_language_sample_is_drawn_again_when_short(dictionaries, monkeypatch):
    texts = numbered(1000)
    whole = dictionaries(texts)
    monkeypatch.setattr(language_id, "DRAWN", 0.1)
    assert dictionaries(texts) == whole
