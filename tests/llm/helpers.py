"""Small tables with the awkward cases that every operator must take."""

import random
import re

WORDS = ("river stone maple winter copper lantern garden thunder velvet orchard compass meadow silver harbor "
         "canyon ember willow falcon marble prairie summit tundra quartz saddle timber voyage anchor beacon").split()
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, fp string, mark string, n string"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


def documents(spark, texts, ids=None, schema=DOC_SCHEMA):
    """A documents table with columns whose names operators use inside, and rows in a few partitions."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en" if k % 3 else None, f"src{k % 2}" if k % 5 else None, None if t is None else len(t),
             "x", "y", "z", "w") for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, schema).repartition(3)


def awkward_texts():
    base = prose(1, 60)
    return [base, base, base + " tail", base.upper(), None, "", " \t\n ", "one", "two words", prose(2, 9), prose(3, 10),
            prose(4, 12_000), "Ünïcödé çà été " * 8, "the " * 300, prose(5, 200), prose(5, 200).replace("river", "stone"),
            "a\u0000b", "%%% ### !!!", prose(6, 80)]


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def groups(ids, linked):
    """The smallest id reachable, by id."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
