"""Small tables with the awkward cases that every operator must take."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; an input may have them as extra columns.
CLASH = ["bucket", "rank", "hash", "key", "d", "k", "a", "b", "path", "count", "id", "language", "domain", "budget",
         "tokens", "_x1", "_span_d", "kept_id", "row"]

WORDS = {
    "en": "the of and house river stone walks under light morning child reads over bridge while rain falls".split(),
    "de": "der und haus fluss stein geht unter licht morgen kind liest brücke während regen fällt über".split(),
    "fr": "le et maison rivière pierre marche sous lumière matin enfant lit pont pendant pluie tombe sur".split(),
}


def prose(rng, lang="en", words=80):
    out = []
    while words > 0:
        n = min(words, rng.randint(6, 14))
        s = [rng.choice(WORDS[lang]) + rng.choice(["", "", "en", "s", str(rng.randint(0, 99))]) for _ in range(n)]
        out.append(" ".join(s).capitalize() + ".")
        words -= n
    return " ".join(out)


def documents(n=60, seed=7):
    """Rows with prose in three languages, exact and near copies, nulls, empty, short and very long texts."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, prose(rng, lang, rng.randint(30, 160)), lang, f"src{i % 5}", None))
    base = rows[3][1]
    rows += [(n + 1, base, "en", "src1", 5), (n + 2, base, "en", "src1", 5)]  # exact copies
    words = rows[6][1].split()
    words[len(words) // 2] = "changed"
    rows += [(n + 3, " ".join(words), "en", "src2", 5)]  # near copy
    rows += [(n + 4, None, "en", "src0", None), (n + 5, "", "de", None, 0), (n + 6, "  \n ", None, "src1", 4),
             (n + 7, "12 34 -- !!", "fr", "src9", 11), (n + 8, "Haus", None, "odd", 4),
             (n + 9, prose(rng, "en", 9000), "en", "src0", None)]
    rows += [rows[0], (None, prose(rng, "fr", 50), "fr", "src2", None), (None, None, None, None, None)]
    return rows


def frame(spark, rows, schema=DOCS, clash=False):
    df = spark.createDataFrame(rows, schema)
    if clash:
        from pyspark.sql import functions as F
        taken = {c.lower() for c in df.columns}
        for c in CLASH:
            if c not in taken:
                df = df.withColumn(c, F.lit("x"))
    return df
