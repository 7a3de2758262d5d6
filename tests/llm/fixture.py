"""A small documents table with the odd cases: nulls, empty and long texts, repeated rows, equal texts,
odd white space, and further columns whose names clash with results."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_words long, score double, "
          "size long, key string, comp long")


def texts(seed=7, n=60):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeéñ") for _ in range(rnd.randint(1, 6))) for _ in range(40)]
    words += ["The", "the", "x.42@mail8.example.com", "10.0.0.1", "4111 1111 1111 1111", "+1 (456) 555-2186", "a1"]
    out = []
    for _ in range(n):
        out.append("".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\n", "  ", ", ", "\t"])
                           for _ in range(rnd.randint(1, 60))))
    base = out[0] + " ".join(words) * 3
    out += [base, base, base + " one more", base.replace("the", "thee"), base[: len(base) * 4 // 5]]
    out += [None, "", " \n ", "one", "two words", "Under the MIT License", "中文 text here", " pad ",
            " ".join(rnd.choice(words) for _ in range(5000)), "1 2 3 !!", "<|endoftext|> a"]
    return out


def rows():
    t = texts()
    langs, out = ["en", "fr", "de", None], []
    for i, x in enumerate(t):
        out.append((i * 3, x, langs[i % 4], [None, "b", "a", "ä", "Z"][i % 5], None, 1, 0.5, 2, "k", 3))
    out += [out[3], out[3], (None, "null id text here", "en", "a", None, 1, 0.5, 2, "k", 3),
            (10**12, t[5], "en", "b", None, None, None, None, None, None)]
    return out


def documents(spark, parts=3):
    return spark.createDataFrame(rows(), SCHEMA).repartition(parts, "doc_id")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
