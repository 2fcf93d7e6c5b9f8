"""Items without an id, and short ones."""

from __future__ import annotations

from storeglass.llm import decontaminate
from tests.llm.test_operators import prose


def test_items_without_id_and_short_items(spark):
    long = prose(10, 12)
    items = spark.createDataFrame([(None, long), (2, "Red  fox"), (3, " "), (4, "42"), (None, "blue")], "item_id long, text string")
    rows = [(1, f"{prose(1, 30)} {long} {prose(2, 30)}"), (2, f"{prose(3, 30)} (red\nfox), {prose(4, 30)} red fox"),
            (3, f"{prose(5, 30)} red foxes infrared fox 421 x42 bluebell"), (4, "42"), (5, "Blue."), (6, ""), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {tuple(r) for r in decontaminate.find(docs, items).collect()}
    allowed = len(long) // decontaminate.CHARS_PER_ERROR
    assert found == {(1, None, 0, allowed, 1), (2, 2, 0, 0, 2), (4, 4, 0, 0, 1), (5, None, 0, 0, 1)}
    assert sorted(r["doc_id"] for r in decontaminate.filter_documents(docs, items).collect()) == [3, 6, 7]
