"""Small tables with everything that may go wrong in them."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, h bigint, id string, row int"


def prose(seed, words, stock=400):
    rng = random.Random(seed)
    syllables = ["ta", "ri", "mo", "len", "sku", "va", "dor", "ple", "ni", "hus"]
    known = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(stock)]
    return " ".join(rng.choice(known) for _ in range(words))


def edge_texts():
    """(doc_id, text): nulls, empty and blank texts, a long one, copies, repeated rows and ids, ties, odd characters."""
    long = prose(5, 20_000)
    return [(1, prose(1, 120)), (2, prose(1, 120)), (2, prose(1, 120)), (3, None), (4, ""), (5, " \n\t\n "),
            (6, "one"), (7, "one two three"), (8, long), (9, long + " tail"), (10, "Ünïcode ß 語 😀 " * 9),
            (None, prose(2, 80)), (None, None), (11, prose(3, 90) + "\n" + prose(1, 60)), (12, prose(1, 120).upper()),
            (13, "12345 !!! ???"), (13, prose(4, 70)), (-3, prose(4, 70))]


def documents(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en" if i is None or i % 2 else None, "s", len(t) if t else None, "clash", 7, "clash", 1)
         for i, t in rows], SCHEMA)


def edges(spark):
    return documents(spark, edge_texts()).repartition(3)


def empty(spark):
    return documents(spark, [])
