"""Small documents with every awkward case: nulls, empty, long, repeated, clashing columns."""

import random

WORDS = "the and river mountain of seven lamps grew under quiet snow while old clocks counted bright harbours beyond lost maps".split()


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def documents():
    long = prose(3000, 99)
    shared = prose(60, 7)
    rows = [
        (1, prose(80, 1), "en"), (2, None, "en"), (3, "", "de"), (4, long, "en"), (5, prose(80, 1), "fr"), (6, prose(30, 2) + " " + shared + " " + prose(30, 3), None),
        (7, shared, "en"), (8, "word", "en"), (9, "ÄÖ ü\tx\n\n\x0b y\x1f", "de"), (None, prose(40, 4), "en"), (11, prose(80, 1) + " tail", "en"), (12, "same same same same\nsame same same same\nother", "en"),
        (13, prose(50, 5), "en"), (13, prose(50, 6), "en"), (1, prose(80, 1), "en"), (14, "   \n ", "en"), (15, "\U0001f600 日本語 text", "ja"), (None, None, None),
    ]
    return [(i, t, lang, f"s{k % 3}", k) for k, (i, t, lang) in enumerate(rows)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
