"""Tables with awkward rows, and plain versions of what the operators compute."""

import random
import re
from collections import Counter

from pyspark.sql import types as T

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Names that operators use inside, as columns of the input.
EXTRA = ["lang", "source", "n_chars", "node", "split", "n", "class", "sig", "keep_id", "digest", "lang_pred", "rank", "bucket", "number"]

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in EXTRA]
)


def words_of(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def sentences(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}é" if r.random() < 0.1 else f"Wo{r.randrange(vocabulary)}" for _ in range(n))


def awkward_rows():
    """(doc_id, text): nulls, empty and long texts, ties, copies and near copies,
    repeated rows, shared passages."""
    base, passage = sentences(1, 90), sentences(2, 60)
    near = base.split()
    near[40] = "other"
    rows = [
        (1, base),
        (2, base),
        (3, base.upper()),
        (4, " ".join(near)),
        (5, None),
        (6, ""),
        (7, " \n\t\x0b "),
        (8, "one two three"),
        (9, "One two three"),
        (10, "one two"),
        (11, sentences(3, 30) + "\n" + passage + "\n\n" + sentences(4, 30)),
        (12, sentences(5, 50) + " " + passage),
        (13, "again and " * 60),
        (14, sentences(6, 9000)),
        (15, "x" * 40_000),
        (16, "1234 5678 !!! ???"),
        (17, "日本語のテキスト　です。 новый текст don't I'LL"),
        (18, sentences(7, 200)),
        (18, sentences(8, 200)),
        (19, sentences(9, 50)),
        (19, sentences(9, 50)),
        (None, sentences(10, 40)),
        (None, None),
        (-20, sentences(11, 40)),
        (100, "a  b  c <|endoftext|> d"),
    ]
    return rows


def written(spark, path, rows, files=3):
    """The rows as a table read from files, with columns of clashing names."""
    full = [(i, t, *(None if k % 3 == 0 else ("en" if c == "lang" else "v") for c in EXTRA)) for k, (i, t) in enumerate(rows)]
    spark.createDataFrame(full, SCHEMA).repartition(files).write.parquet(str(path))
    return spark.read.parquet(str(path))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def shingles(text, size=5):
    w = words_of(text, lower=True)
    if not w:
        return frozenset()
    if len(w) < size:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def components(rows, size=5):
    """(doc_id, n_shingles, component_id) of every row, by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b:
                both = len(a & b)
                if 100 * both >= 75 * (len(a) + len(b) - both):
                    parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def without_repeated(rows, size=35):
    """(doc_id, words, kept words) of every row."""
    split = [(d, words_of(t)) for d, t in rows]
    seen = Counter(tuple(w[i : i + size]) for _, w in split for i in range(len(w) - size + 1))
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        out.append((d, w, [x for x, g in zip(w, gone) if not g]))
    return out
