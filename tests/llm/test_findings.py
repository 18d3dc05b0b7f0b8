"""What a reviewer's findings showed of the text operators: each test failed before its finding was settled."""

from test_pii import CARD, OTHER, trained

from snapquarry.llm import pii as I


def test_texts_without_a_base_span_go_through_the_field(spark):
    """Two cards side by side match no pattern, and a written-out address has neither digit nor @; what is found there is told apart, and nothing else changes."""
    texts = [f"no base span here: {OTHER} {CARD}", "me(at)mail.example.com", f"pay {CARD} now. Later {OTHER} {CARD} came", "in 2024 we had 12 pages", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in I.scan(df, trained(), ["doc_id"]).collect()}
    assert [(got[k].spans, got[k].alone) for k in (0, 1, 3, 4)] == [("", "card:19:35,card:36:52"), ("", "email:0:22"), ("", ""), ("", "")]
    assert got[2].spans.count("card") == 3 and got[2].alone == ""
