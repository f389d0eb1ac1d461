"""Small tables with the awkward rows every operator has to take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: further columns whose names clash with what operators compute
CLASHES = {"size": 1, "taken": "x", "n": 2, "node": 3, "key": "k", "h": 4, "label": 5, "score": "s", "id": 9, "t": "t",
           "_id": 8, "_gone": 1, "gone": 2, "secret_spans": 3, "_matches": 4, "_language": 5, "target": 6, "mix_key": 7, "runs": 1,
           "fp": 2, "word": "w", "variant": 3, "hash": 7, "language": "l", "spans": "p", "source_size": 0}


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    out = [f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.randrange(vocabulary)}x"
           for _ in range(words)]
    return " ".join(out)


def awkward_rows(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    long_text = prose(rng, 30_000)
    return [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "   \n\t ", None, None, None), (4, "one", "en", None, 3),
        (5, "Two words", "en", "b", 9), (6, long_text, "en", "b", len(long_text)), (7, long_text, "fr", "c", len(long_text)),
        (8, "x" * 50_000, "en", "c", 50_000), (None, "no id here at all", "en", "a", 5), (None, None, None, None, None),
        (10, "same row twice in the table", "en", "a", 1), (10, "same row twice in the table", "en", "a", 1),
        (11, "Ünï cödé   and   tie", "de", "é", 3), (12, "Ünï cödé   and   tie", "de", "é", 3),
        (13, "###$$$ %%% *** !!!", "en", "z", 1),
    ]


def awkward(spark, clashes: bool = True):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(awkward_rows(), SCHEMA)
    return df.withColumns({k: F.lit(v) for k, v in CLASHES.items()}) if clashes else df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
