"""Similar windows are seldom lost by their fingerprints."""

import random

from test_llm_native import found_in


def test_documents_a_word_shorter_than_a_short_item(spark):
    random.seed(41)
    items = [[f"i{number}x{place}" for place in range(9)] for number in range(300)]
    texts = [(number, " ".join(item[:-1])) for number, item in enumerate(items)]
    got = found_in(spark, texts, [(number, " ".join(item)) for number, item in enumerate(items)])
    assert set(got.values()) == {(0.8, 0)} and all(doc == item for doc, item in got)
    assert len(got) >= 290
