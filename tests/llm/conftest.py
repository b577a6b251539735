import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from strataflow.llm.common import ship
    from strataflow.session import build_session, checkpoint_root
    s = build_session("local[4]", app="strataflow-llm-tests", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)
    return ship(s)


@pytest.fixture(scope="session")
def vocabulary():
    from strataflow.llm.queries import vocabulary_file
    return vocabulary_file()


#: Documents with nulls, empties, repeats, ties, a very long text and clashing extra columns.
EDGE = [
    (1, "The cat sat on the mat."), (2, None), (3, ""), (4, " \t\n "), (5, "one"), (6, "one two"),
    (7, "The cat sat on the mat."), (7, "The cat sat on the mat."), (None, "no id at all here"), (None, None),
    (8, "x" * 50_000 + " " + "word " * 30_000), (9, "Ünïcödé straße İstanbul 漢字 test́   nbsp"), (10, "!!! 123 ... ---"),
]


@pytest.fixture()
def edge_docs(spark):
    rows = [(i, t, "en" if t else None, "s", -1, "clash", 0) for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, id long, row string, fp long")
