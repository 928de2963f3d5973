import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
from tradeloom.session import build_session

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "llm-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "3",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def corpus():
    """Texts with copies, near copies, short, empty, null and very long ones, other scripts, ties."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    base = [text(rng.randint(40, 90)) for _ in range(12)]
    rows = []
    for k, x in enumerate(base):
        rows.append((3 * k, x))
        words = x.split()
        words[5] = "CHANGED"
        rows.append((3 * k + 1, " ".join(words)))
    passage = text(30)
    rows += [(100 + k, text(20) + "\n" + passage + "\n" + text(15)) for k in range(5)]
    rows += [(200, base[0]), (201, base[0].upper()), (202, ""), (203, None), (204, " \t\n "), (205, "one two"), (206, "one two")]
    rows += [(207, "é" * 70 + " ñandú 日本語 " + base[1]), (208, "x" * 30_000), (209, " ".join([base[2]] * 60)), (-7, base[3])]
    rows += [(210, base[4]), (210, base[4]), (None, base[5]), (None, None), (211, text(60)), (211, text(50))]
    sources = ["b", "a", None, "c"]
    return [(i, t, "en", sources[k % 4], len(t or "")) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
