import random

import pytest

SCHEMA = "doc_id long, text string, source string, lang string, norm string, row int, size int, taken int, rep long, key string, text_sha256 string"


def edge_rows():
    """Nulls, empty and long texts, ties, repeated rows, copies in another case, near copies."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghé") for _ in range(rng.randint(2, 7)))
    base = [" ".join(word() for _ in range(60)) for _ in range(12)]
    rows = [(i, t, f"s{i % 3}", "en") for i, t in enumerate(base)]
    for i, t in enumerate(base[:4]):
        rows.append((100 + i, t.upper() if i % 2 else t, "s0", "en"))
        words = t.split()
        words[30] = "changed"
        rows.append((200 + i, " ".join(words), None, "de"))
        words[45] = "again"
        rows.append((300 + i, "\n".join(words), "s1", None))
    rows += [(400, None, "s1", "en"), (401, "", "s1", "en"), (402, " \t\n", None, None), (None, base[5], "s2", "en"), (None, None, None, None)]
    rows += [(403, "one two", "s2", "en"), (404, "One\ttwo", "s2", "en"), (405, "É one", "s2", "en"), (406, "é one", "s2", "en"), (407, "same", "s0", "en"), (407, "same", "s0", "en")]
    rows += [(408, base[7] + " " + " ".join(word() for _ in range(20_000)), "s0", "en"), (409, "aaaa" * 5000, "s0", "en"), (410, base[8] + "\n" + base[8], "s1", "en")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return edge_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with extra columns whose names clash with those that the operators make."""
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, "k", "z") for r in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
