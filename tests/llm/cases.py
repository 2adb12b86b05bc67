"""Small document tables with all the odd cases."""

import random

SCHEMA = "doc_id long, text string, source string, n_words int, digest string, row string"


def documents(spark, rows=None):
    """Rows of (doc_id, text); further columns have names that operators use inside."""
    rows = odd_rows() if rows is None else rows
    return spark.createDataFrame([(i, t, f"s{k % 3}", k, "x", None) for k, (i, t) in enumerate(rows)], SCHEMA)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(n))


def odd_rows(seed=1):
    rng = random.Random(seed)
    base = sentence(rng, 120)
    words = base.split(" ")
    near = words.copy()
    near[60] = "other"
    shared = sentence(rng, 55)
    rows = [(1, base), (2, " ".join(near)), (3, None), (4, ""), (5, "   \n\t "), (6, "one two three"), (7, base), (8, base.upper()), (8, sentence(rng, 40)),
            (9, "Orre " * 300), (10, sentence(rng, 30) + " " + shared + " " + sentence(rng, 30)), (11, sentence(rng, 5) + "\n" + shared + "\n" + sentence(rng, 9)),
            (12, sentence(rng, 6000)), (13, "tail\r\n\x0bword " + shared), (7, base), (None, shared), (None, base), (14, "ünï \U0001f600 ▁ " + shared + "\n"), (15, "one two three"),
            (16, "x" * 40000), (17, "\n".join([sentence(rng, 8)] * 4))]
    rng.shuffle(rows)
    return rows
