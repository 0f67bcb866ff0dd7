"""Small tables with every awkward row, and brute-force versions of the operators."""

import random
import re
from collections import Counter

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, bucket string, _text string, words string, "
          "n_words string, component string, a string, score string, _llm_text string, tkey string")
JUNK = ("x",) * 6
EXTRA = (7, "b", "t", "w", "n", "c", "a", "s", "l", "k")


def row(doc_id, text, source="s1"):
    return (doc_id, text, "en", source, len(text or ""), *EXTRA)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark):
    """Copies, near copies, shared passages, ties, nulls, blanks, a long text, repeated rows and clashing columns."""
    rng = random.Random(5)
    base = [prose(rng, rng.randrange(60, 160)) for _ in range(12)]
    passage = prose(rng, 70)
    rows = [row(i, t) for i, t in enumerate(base)]
    rows += [row(100 + i, base[i], "s2") for i in range(4)] + [row(110, base[0]), row(111, base[0])]
    for i in range(6):
        words = base[5].split()
        for _ in range(i):
            words[rng.randrange(len(words))] = "changed"
        rows.append(row(120 + i, " ".join(words), "s3"))
    rows += [row(140 + i, f"{prose(rng, 20)} {passage} {prose(rng, 15)}") for i in range(4)]
    rows += [row(150, None), row(151, ""), row(152, " \n\t "), row(153, "one two"), row(154, "One TWO"), row(155, "é ü 日本語  x"),
             row(156, prose(rng, 30_000, 50)), row(157, passage + " " + passage), row(158, "a " * 120),
             row(None, base[1]), row(None, None), row(3, base[3]), row(3, base[3]), row(159, base[7], None)]
    return spark.createDataFrame(rows, SCHEMA), [(r[0], r[1]) for r in rows]


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return BLANK.findall(text or "")


def shingles(text, size=5):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)])


def components(rows, percent):
    """doc_id -> component of rows (doc_id, text) with ids."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in parent}


def without_repeats(rows, window):
    """Kept words of each row (doc_id, text), in order."""
    owner = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1) if i is not None else ():
            key = tuple(w[k:k + window])
            owner[key] = min(owner.get(key, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1) if i is not None else ():
            if owner[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        out.append([x for k, x in enumerate(w) if k not in gone])
    return out


def repeated_words(w):
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    return len({k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)})
