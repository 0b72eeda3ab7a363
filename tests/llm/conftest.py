from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        # names that the operators use inside
        "id long, at string, key string, row string, `check` string, kept string, fp string, size int, seed string, "
        "piece string, length string, part string, n_words string, component_id string, score string, spans string")


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = "an er th on re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    out = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words)]
    return " ".join(w + (". " if rng.random() < 0.08 else "") for w in out).strip()


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, copies, near copies, repeated rows, odd characters."""
    base = prose(1, 120)
    texts = [(1, None), (2, ""), (3, " \n\t \r"), (4, base), (5, base), (6, base.replace("the", "tha", 1)), (7, prose(2, 90)),
             (7, prose(2, 90)), (7, prose(3, 90)), (None, prose(4, 80)), (None, None), (8, "one"), (9, "two words"),
             (10, "<|endoftext|>a <|endoftext|>"), (11, "é½²中​ \U00010940x1 don't I'LL \x85 　 \x00 ՘"),
             (12, "a" * 60_000), (13, prose(5, 40_000)), (14, "Mail me: a.b@mail.example.com or 10.0.0.1, +1 (499) 555-6503, "
                                                             "4539 1488 0343 6467."), (15, "12345.6.7.8.9 @ @@ +1"), (16, base)]
    filler = [None] * 16
    rows = [(i, t, None if k % 5 == 0 else ("en", "de")[k % 2], None if k % 7 == 0 else f"s{k % 3}",
             None if t is None else len(t), *filler) for k, (i, t) in enumerate(texts)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
