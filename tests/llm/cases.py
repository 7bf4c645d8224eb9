"""Small tables with nulls, ties, repeated rows, long texts and columns of clashing names."""

import random

from pyspark.sql import functions as F

ODD = [
    None, "", " ", "\n\n", "one", "one two three four", "a b c d e", "A b c d e",
    "Straße №5 – naïve café 日本語 🙂 <|endoftext|> x<|startoftext|>y", "tab\tand no-break thin\x1cfs\x85nel", "##### $$$ |||",
    "the same line\nthe same line\n\nthe same line", "ß" * 300, "!" * 200, "it's we'll they'd I'VE", " lead", "trail ", "1234567890 ½ ² Ⅷ",
]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    parts = "an ber cho den est fi gra hol in ka lor men no pre qui ris sta tor un ver".split()
    words = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n)]
    return "".join(w + (".\n" if k % 17 == 16 else " ") for k, w in enumerate(words)).strip()


def texts() -> list:
    long_ = prose(1, 30_000)
    near = prose(2, 100).split(" ")
    return [*ODD, long_, prose(3, 80), prose(3, 80), prose(4, 200), " ".join(near), " ".join([*near[:-1], "other"]), " ".join([*near[1:], "more"])]


def documents(spark, rows=None):
    """doc_id, text, lang, and columns that operators use themselves."""
    rows = [(i, t, ("en", "de", None)[i % 3]) for i, t in enumerate(texts())] if rows is None else rows
    rows = rows + [(None, "no id at all here, none of it", "en")] * bool(rows) + rows[18:19] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    more = "class root set word part block held bucket ids length task nth _bit score seed page_id".split()
    return df.withColumns({c: F.lit(c) for c in more}).repartition(2)
