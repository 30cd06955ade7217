"""Small tables with every odd case: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, hash long, node long, row long, segment int, key long, size long, words string"


def sentence(rng, n):
    return " ".join(rng.choice("the of and Tree house River stone über été walk green 7 x2 cloud".split()) + rng.choice(["", "s", "ing"]) for _ in range(n))


def rows(seed=5):
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(30, 90)) for _ in range(14)]
    out = []
    for i, text in enumerate(base):
        out.append((i * 3, text, "en" if i % 3 else None, f"s{i % 3}"))
    for i in range(6):  # near copies, copies, texts that share a passage
        words = base[i].split()
        words[len(words) // 2] = "changed"
        out.append((100 + i, " ".join(words), "en", "s0"))
        out.append((200 + i, base[i], "de", None))
        out.append((300 + i, sentence(rng, 12) + "\n" + base[7][20:140] + "\n" + sentence(rng, 9), "fr", "s1"))
    out += [(400, None, "en", "s0"), (401, "", None, None), (402, " \n\t ", "en", "s0"), (403, "é", "fr", "s0"), (404, "ab", "en", "s2"), (405, "12 34 !!", "en", "s2")]
    out += [(500, " ".join(base) * 40, "en", "s0"), (501, "a" * 30_000, "en", "s0"), (502, "para " * 4000, "en", "s0")]
    out += [(None, base[3], "en", "s0"), (None, None, None, None), (0, base[0], "en", "s1"), (0, base[0], "en", "s1"), (3, base[5] + " tail", "en", "s1")]
    return [(*r, len(r[1] or ""), 0.5, 1, 2, 3, 4, 5, 6, "w") for r in out]


def frame(spark, seed=5):
    return spark.createDataFrame(rows(seed), COLUMNS).repartition(5)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)
