from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, stems: str = "ka lo mi ren tu vas pel dor fi gun") -> str:
    rng = random.Random(seed)
    parts = stems.split()
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    return "\n".join(" ".join(words[k : k + 12]).capitalize() + "." for k in range(0, n, 12))


def rows() -> list[tuple]:
    """Prose in two 'languages', copies, near copies, and every odd case."""
    out = []
    for i in range(40):
        lang = "xx" if i % 2 else "yy"
        out.append((i, prose(i, 60 + 7 * i, "ka lo mi ren tu" if i % 2 else "és or üb ing wha"), lang, f"s{i % 3}"))
    out.append((100, out[3][1], "xx", "s0"))  # exact copy
    out.append((101, out[9][1].replace("Ka", "Kax", 1), "xx", "s0"))  # near copy
    out.append((102, out[3][1] + "\nMore of it.", "xx", "s0"))
    out += [(103, None, "xx", "s0"), (104, "", "yy", "s1"), (105, " \n\t ", "xx", None), (106, "Word", None, "s1"), (107, "1234 5678 !!", "xx", "s2")]
    out.append((None, prose(77, 80), "xx", "s0"))
    out.append((108, "lala " * 30_000, "xx", "s0"))  # a long text of one word
    out.append((109, "x" * 50_000, "yy", "s0"))  # a long word
    out.append(out[5][:4])  # a repeated row
    out.append((110, "Released under the MIT License.\n" + prose(5, 60), "xx", "s0"))
    return [(*r, None if r[1] is None else len(r[1])) for r in out]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3, "source").cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 5 != 0), int(i == 7)) for i in range(30)] + [(None, 1, 0), (31, None, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def benchmark(spark):
    words = prose(9, 130, "ka lo mi ren tu").split()
    return spark.createDataFrame([(0, " ".join(words[20:50])), (1, prose(999, 30)), (2, None), (3, ""), (4, "Word"), (0, " ".join(words[20:50]))], "item_id long, text string")
