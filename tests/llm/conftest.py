import pytest
from pyspark.sql import Row

from cohortloom.llm.workspace import Workspace

#: Names that operators use inside, with values of other types.
CLASHES = {"node": "x", "root": 1.5, "digest": True, "rep": "y", "size": "z", "copies": "w", "draw": "v", "row": "u",
           "key": "t", "score": "s", "label": "r", "id": "q", "doc": "p", "h1": "o", "kept": "n", "item_id": "m"}


@pytest.fixture()
def work(spark):
    with Workspace(spark, "test") as made:
        yield made


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with a source, a language and clashing columns."""

    def make(pairs, clash=True):
        rows = [
            Row(doc_id=i, text=t, lang="en", source=("a", "b", None)[n % 3], n_chars=len(t or ""), **(CLASHES if clash else {}))
            for n, (i, t) in enumerate(pairs)
        ]
        extra = ", node string, root double, digest boolean, rep string, size string, copies string, draw string, row string, key string, score string, label string, id string, doc string, h1 string, kept string, item_id string"
        schema = "doc_id long, text string, lang string, source string, n_chars int" + (extra if clash else "")
        return spark.createDataFrame(rows, schema)

    return make


#: Nulls, blanks, repeats and ties that every operator must take.
ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "one two three four five six"), (4, "one two three four five six"),
       (4, "one two three four five six"), (5, "short"), (6, "short"), (7, "word " * 20_000), (8, "x" * 60_000), (None, None)]
