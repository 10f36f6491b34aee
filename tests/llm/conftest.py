from __future__ import annotations

import random

import pytest

from tidemark.llm.common import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["th", "er", "an", "é", "in", "ou"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def documents(seed: int = 7) -> list[tuple]:
    """Copies, shared passages, repeated rows, nulls, empty, odd and long texts."""
    rng = random.Random(seed)
    passage = prose(rng, 80)
    base = [prose(rng, rng.choice([1, 3, 20, 90, 200])) for _ in range(24)]
    texts = [*base, base[3] + "\n" + passage, passage + " tail words", "head, " + passage, base[5], base[5], base[7] + " x"]
    words = base[11].split() or ["a"]
    texts += [" ".join(words[:-1] + ["changed"]), "", " \t\n", None, "x" * 900, "ab" * 600, prose(rng, 6000), "ÀÉ\x1c\x85 \xa0 end\x0b"]
    rows = [(n, t, "en", f"s{n % 3}", len(t or "")) for n, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, base[9], "en", "s", 5), (None, None, None, None, None), (100, passage, "en", "s", 1)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    spark.createDataFrame(documents(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """Extra columns named like what operators add or use."""
    names = (
        "packed row start end length offset sequence_id piece ids score predicted fingerprint component_id _row _id _group "
        "_lent next found windows anchors starts ends spans _spans _base node root v a b"
    ).split()
    from pyspark.sql import functions as F

    return docs.withColumns({n: F.lit(n) for n in names})
