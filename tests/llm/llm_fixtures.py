import random

import pytest

SF = "/root/testdata/sf0.001"
#: Names that operators use inside, as extra columns of the input.
CLASHING = ["node", "sig", "role", "size", "group", "part", "row", "byte", "shard", "spans",
            "text_key", "kept", "mix", "mixw", "topic", "tokens", "component", "v", "a", "b",
            "slot", "seed", "held_out", "quality", "weight"]


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty, wordless, short, long, equal and repeated rows."""
    rng = random.Random(4)
    long = " ".join(words(rng, 30_000, 50_000))
    near = words(rng, 400)
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (6, long),
             (7, long + " tail"), (8, " ".join(near)), (9, " ".join(near[:-3] + ["x", "y", "z"])),
             (10, "😀 é 中文 " * 40), (11, "x" * 70_000), (None, "one two"), (12, "12345 678"),
             (13, "!" * 100), (8, " ".join(near))]
    return [(i, t, None if i and i % 4 == 0 else "en", None if i == 6 else "src0",
             None if t is None else len(t)) for i, t in texts]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    extra = ", ".join(f"`{c}` int" for c in CLASHING)
    return spark.createDataFrame([(*r, *[7] * len(CLASHING)) for r in edge_rows],
                                 f"{schema}, {extra}")


@pytest.fixture(scope="session")
def empty(edge):
    return edge.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
