import random

import pytest

SYLLABLES = "ta ro mi ne lu ka so pe di vu ga ho ze fi".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(2, 4))) for _ in range(words))


LONG = prose(99, 12_000)
BASE = prose(1, 160)
TEXTS = [
    None, "", " \n\t ", "one", BASE, BASE, BASE.replace(BASE.split()[80], "changed", 1), prose(2, 90), prose(3, 400), LONG,
    "mail a.b@mail.example.com or +1 (555) 123-4567, card 4111 1111 1111 1111 from 10.0.0.255 at 1.2.3.999",
    f"{prose(4, 30)} {' '.join(prose(5, 70).split())} {prose(6, 30)}", f"{prose(7, 20)} {' '.join(prose(5, 70).split())}",
    "x" * 5000, "é😀 ünïcode text  with   gaps <|endoftext|> \n\n end",
]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, copies, a repeated row, a null id, and columns with names used inside the operators."""
    rows = [(i, text, "en", None if i % 5 == 0 else f"s{i % 3}", len(text or ""), "v", i, 0.5) for i, text in enumerate(TEXTS)]
    rows.append((3, "one", "en", "s0", 3, "v", 3, 0.5))
    rows.append((None, "no id here", None, "s1", 10, "v", 0, 0.5))
    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, size long, score double"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
