"""Small tables with copies, near copies, shared passages and odd rows."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string"
# columns that operators use inside, or return
CLASHES = (
    "unit bucket n digest spans doc rest length part bin_id score lang_pred kept keep_id group_size _run _slot "
    "items n_words factors component_id _rank _class found gone url x seen"
).split()


def words(rng: random.Random, n: int, size: int = 400) -> list[str]:
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def rows(seed: int = 5, n: int = 60) -> list[tuple[int | None, str | None]]:
    """Documents with exact copies, edited copies, one common passage and every odd text."""
    rng = random.Random(seed)
    passage = words(rng, 60)
    bases = [words(rng, rng.randint(30, 220)) for _ in range(8)]
    out: list[tuple[int | None, str | None]] = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.25:
            text = words(rng, rng.randint(1, 120))
        elif kind < 0.5:
            text = list(rng.choice(bases))
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = f"Edit{rng.randrange(99)}"
        elif kind < 0.75:
            text = words(rng, 40) + passage[rng.randint(0, 20) :] + words(rng, 10)
        else:
            text = list(rng.choice(bases))
        at = sorted(rng.sample(range(len(text) + 1), min(4, len(text))))
        joined = " ".join(text) if len(text) < 5 else "\n".join(
            " ".join(text[a:b]) for a, b in zip([0, *at], [*at, len(text)])
        )
        out.append((i * 3, joined))
    odd = [
        None,
        "",
        "  \n\t ",
        "word",
        "word",
        "ONE two",
        "one  two",
        "é ß 中文 Ünïcode",
        "a " * 500,
        "a " * 500,
        "\n\nx\n\n",
        " ".join(words(rng, 6000)),
        "token = \"0123456789abcdef0123\" end",
    ]
    out += [(1000 + i, t) for i, t in enumerate(odd)]
    # rows that come twice, and rows without an id
    out += [out[3], out[3], (None, out[5][1]), (None, None)]
    return out


def frame(spark: SparkSession, data: list[tuple], schema: str = SCHEMA, *, clash: bool = True) -> DataFrame:
    """The rows in several partitions, with other columns under names that operators use."""
    df = spark.createDataFrame(data, schema).repartition(3)
    extra = [c for c in CLASHES if c not in df.columns] if clash else []
    return df.select("*", *[F.lit(None if i % 2 else "?").cast("string").alias(c) for i, c in enumerate(extra)])
