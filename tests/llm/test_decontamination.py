"""How the decontamination meets its documents again."""

from rosterlake.llm import decontamination
from tests.conftest import plan

DOCS = "doc_id bigint, text string"


def test_hits_are_never_broadcast(spark):
    """The plan is the same for few and many hits, and what is shuffled is the text, not the hashes of its words."""
    item = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, item), (1, "other words"), (2, f"so {item}"), (3, "nothing"), (None, item)], DOCS)
    pairs = decontamination.contaminated_items(docs, spark.createDataFrame([(7, item)], "item_id bigint, text string"))
    assert sorted((r["doc_id"], r["item_id"], r["share"]) for r in pairs.collect()) == [(1, 7, 1.0), (2, 7, 1.0)]
    text = plan(pairs)
    assert "SortMergeJoin [doc_id" in text
    below = text[text.index("SortMergeJoin [doc_id"):]
    assert "regexp_extract_all" in text[:text.index("SortMergeJoin [doc_id")] and "regexp_extract_all" not in below[:below.index("Exchange")]
