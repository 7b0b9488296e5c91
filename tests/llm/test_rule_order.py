"""The rows that the order of the rules is estimated on decide no verdict."""

import pytest

from wayfare.llm import rules

from .conftest import frame


@pytest.mark.parametrize("first", ["few words", "A LOT OF SHOUTING " * 40, "# $ % & " * 40, "1234 5678 " * 40])
def test_rows_kept_do_not_follow_the_first_rows(spark, first):
    good = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))
    rows = [(i, first) for i in range(600)] + [(600 + i, text) for i, text in enumerate(
        [good, good.upper(), good + " #" * 30, "short", (good + "\n") * 9, good + " 1234567890" * 30, None, good + " end"])]
    docs = frame(spark, rows).coalesce(1)
    kept = rules.filter_documents(docs, rules.order_rules(docs))
    assert [r.doc_id for r in kept.select("doc_id").orderBy("doc_id").collect()] == [600, 607]
