"""Small document frames, with columns whose names the operators use themselves."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, found string, row string, bucket string, dropped_lines string"


def docs(spark, *rows):
    """Rows are (doc_id, text) or (doc_id, text, lang)."""
    data = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None if r[1] is None else len(r[1]), 7, "x", "y", "z", "w") for r in rows]
    return spark.createDataFrame(data, SCHEMA)


def prose(seed, words, letters="abcdefgh"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(words))


def edited(text, seed, changes):
    """``text`` with single characters replaced, inserted or deleted."""
    rng = random.Random(seed)
    for _ in range(changes):
        at = rng.randrange(len(text))
        kind = rng.randrange(3)
        text = text[:at] + ("" if kind == 0 else rng.choice("xyz")) + text[at + (kind != 1) :]
    return text
