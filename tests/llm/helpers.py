"""Small document tables with everything that may stand in one."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: Extra columns whose names clash with those the operators use inside.
EXTRA = "row_key long, _row_key long, node long, key string, batch long, shard int, n string, class string, features string"


def frame(spark: SparkSession, rows: list[tuple[int | None, str | None]], extra: bool = True) -> DataFrame:
    """``doc_id, text`` with clashing extra columns."""
    clash = (7, 7, 7, "x", 7, 7, "x", "x", "x")
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string")
    return spark.createDataFrame([(*r, *clash) for r in rows], f"doc_id long, text string, {EXTRA}")


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def mixed_rows(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """Plain texts, exact and near copies, repeated rows, null and empty texts, a null id, a long text."""
    rng = random.Random(seed)
    base = [prose(rng, rng.choice([3, 12, 40, 120])) for _ in range(12)]
    rows: list[tuple[int | None, str | None]] = [(k, t) for k, t in enumerate(base)]
    rows += [(20 + k, base[3]) for k in range(5)]  # exact copies
    for k in range(8):  # near copies
        words = base[4 + k % 4].split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((30 + k, " ".join(words)))
    rows += [(40, None), (41, ""), (42, " \n\t "), (43, "é ß 日本語 " * 30), (44, prose(rng, 6000)), (45, base[0] + "\n" + base[1])]
    rows += [(1, base[1]), (1, base[1]), (None, base[2]), (None, None)]
    return rows


def words_of(text: str | None, pattern: str) -> list[str]:
    return re.findall(pattern, (text or "").translate(LOW))
