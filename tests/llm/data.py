"""A small table with every awkward case: nulls, empty and very long texts, ties, repeats, extra columns."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row string, t string, h string, shard string, fp string, x string, token string, spans string, score string")
EXTRA = len(SCHEMA.split(",")) - 5


def words(rng, n, vocabulary=400):
    return [rng.choice("ab cd ef gh".split()) + str(rng.randrange(vocabulary)) for _ in range(n)]


def texts():
    rng = random.Random(7)
    base = [words(rng, 60) for _ in range(12)]
    out = [" ".join(b) for b in base]
    for b in base[:6]:
        near = list(b)
        near[3] = "changed"
        out.append(" ".join(near))
        out.append("\n".join([" ".join(words(rng, 20)), " ".join(b), " ".join(near), "", " ".join(b)]))
    out += [" ".join(base[0]), " ".join(base[0]), "", None, "one", "a\tb\x0bc\x1cd e  f\r\n\n", " ".join(words(rng, 8000)),
            "word " * 3000, "x" * 5000, "tokén \U0001f600 你好 ՘ ࢏ <|endoftext|> İstanbul ΣΣ",
            "über die straße  ging\n\n der   mann", "...", "   \n ", "123 456"]
    return out


def rows():
    found = [(i * 3, t, "en" if i % 2 else None, f"s{i % 4}", None) for i, t in enumerate(texts())]
    found += [found[0], found[0], (None, "null id " * 9, None, None, 3), (None, None, None, None, None),
              (found[2][0], "same id other text " + " ".join(words(random.Random(1), 30)), "de", "s9", 1)]
    return [r + ("clash",) * EXTRA for r in found]


def frame(spark, found=None):
    return spark.createDataFrame(rows() if found is None else found, SCHEMA)


def plain(spark, pairs):
    """A table of (doc_id, text) with the other columns null."""
    return spark.createDataFrame([(i, t, None, "s", None) + (None,) * EXTRA for i, t in pairs], SCHEMA)
