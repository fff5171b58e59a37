"""Rows that every operator must stand: nulls, empty and long texts, ties, repeats, columns with clashing names."""

import random

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, n_tokens string, shard string, "
          "line string, id string, key string, kept string, score string, n_lines string, rank string, `a.b` string")
SYLLABLES = "the on er ing ha re ti or nd st é ü ß ñ 東 a".split()


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def texts():
    rng = random.Random(3)
    base = words(rng, 300)
    near = list(base)
    near[150] = "changed"
    body = " ".join(words(rng, 60))
    passage = " ".join(words(rng, 20)) + "."
    return [
        None, "", " \n\t ", "one", "two words", " ".join(base), " ".join(base), " ".join(near),
        "  " + passage + "\n" + body, passage.upper() + " \nother text here\n" + passage, passage + "\n\nlast line é",
        "<|endoftext|>a<|startoftext|> it's 12 don't\x0bstop now 　 x", "Á İI ﬁ é Å 🙂🙂 ．", "a\r\nb c\x1cd",
        " ".join(words(rng, 5000)), "x" * 5000, "\n" * 50, "# * $ % & | < > !", passage, passage]


def edge_rows():
    found = [(i, t) for i, t in enumerate(texts())]
    found += [(5, found[5][1]), (6, "another text under a known id"), (None, "text without an id"), (None, None),
              (-3, "negative"), (2 ** 40, found[7][1])]
    return [(i, t, "en" if i is None or i % 3 else None, None if i == 4 else f"s{(i or 0) % 2}", None if t is None else len(t))
            + ("clash",) * 10 for i, t in found]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(rows):
    return [(r[0], r[1]) for r in rows]
