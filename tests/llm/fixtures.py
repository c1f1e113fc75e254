"""Small tables with the awkward cases: nulls, empty texts, ties, repeated rows, clashing column names, long texts."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, row string"

SYLLABLES = {
    "en": ["the", "ing", "tion", "and", "wh", "th", "er", "ly", "of", "re"],
    "fr": ["eau", "oi", "le", "é", "ç", "une", "ê", "ment", "què", "ou"],
    "de": ["sch", "ung", "ß", "ä", "der", "ich", "ö", "ver", "und", "ü"],
}


def sentence(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(words))


def texts(seed=0, n=60):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        lang = rng.choice(list(SYLLABLES))
        out.append((lang, "\n".join(sentence(rng, lang, rng.randrange(1, 40)) for _ in range(rng.randrange(1, 7)))))
    return out


def documents(spark, extra=(), seed=0, n=60, partitions=3):
    rows = [(k, t, lang, f"src{k % 5}" if k % 7 else None, len(t), 1.0, "k", "r") for k, (lang, t) in enumerate(texts(seed, n))]
    rng = random.Random(seed + 1)
    rows += [(len(rows) + k, rows[rng.randrange(n)][1], "en", "src0", 1, None, None, None) for k in range(15)]  # copies
    for k in range(15):  # near copies
        words = rows[rng.randrange(n)][1].split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((200 + k, " ".join(words), None, "src0", 1, None, None, None))
    rows += [(300, None, None, None, None, None, None, None), (301, "", "en", "src1", 0, 0.0, "", ""), (302, "   \n \t", "en", "src1", 5, 0.0, "", "")]
    rows += [(303, "12345 !!", None, "src1", 8, 0.0, "", ""), (304, "x" * 50_000, "en", "src2", 50_000, 0.0, "", "")]
    rows += [(305, sentence(rng, "en", 20_000), "en", "src2", 0, 0.0, "", ""), (None, "no id here at all, my friend", "en", "src1", 0, 0.0, "", "")]
    rows += [rows[3], rows[3], (306, "one two three", "en", "src3", 0, None, None, None)]
    rows += list(extra)
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def pandas_rows(df):
    return [r.asDict() for r in df.collect()]
