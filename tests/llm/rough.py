"""Small tables with every oddity the operators have to bear."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, fp long, a long, b long, votes int, "
          "lang_pred int, score string, rejected string, start long, spans string, doc_ids string, length long")


def prose(seed, n, lang="en"):
    rng = random.Random(seed)
    parts = {"en": ["th", "ing", "er", "an", "on", "re"], "de": ["sch", "ung", "ein", "ver", "keit", "ü"]}[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) + rng.choice(["", "", "", ",", "."])
                    for _ in range(n))


def texts():
    base = [prose(i, 60 + i, "en" if i % 3 else "de") for i in range(40)]
    words = base[0].split()
    passage = prose(99, 70)
    return base + [
        base[0], base[0], " ".join(words[:30] + ["changed"] + words[31:]), None, None, "", " \n\t ", "one", "12 34 !!",
        base[5] + "\n" + passage, passage + "\n" + base[6], "x" * 20_000, "lone " * 3_000, prose(7, 9_000),
        "Ünï çödé 日本語 🙂 " * 20, "<|endoftext|> mid <|startoftext|> end", "a\x1cb \x1d c", "### $$$ " * 40,
        "Same line here now.\n" * 12, "tabs\tand  blanks \n here ",
    ]


def rows():
    langs = [("en" if i % 3 else "de") for i in range(40)] + [None] * 40
    out = [(i, t, langs[i], None if i % 7 == 0 else f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts())]
    out += [(3, texts()[3], "de", "again", 1), (3, texts()[3], "de", "again", 1), (None, texts()[4], "en", None, None),
            (None, None, None, None, None)]
    return [r + (1, 2, 3, 4, 5, "s", "r", 6, "t", "u", 7) for r in out]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
