"""Small tables and plain reference implementations for the tests of this folder."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
KINDS = "doc_id long, text string, lang string, source string, n_chars long, kept string, component_id string, shard string, score string, _row string"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, size=5):
    own = words(text)
    return {tuple(own[i:i + size]) for i in range(max(1, len(own) - size + 1))} if own else set()


def prose(seed, count, vocabulary=400):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}x" for _ in range(count))


def edited(text, seed, edits):
    pick, own = random.Random(seed), text.split()
    for _ in range(edits):
        own[pick.randrange(len(own))] = f"e{pick.randrange(10**6)}"
    return " ".join(own)


def edge_rows():
    """Null, empty, blank, short, very long, equal, near-equal and repeated texts; ids that are null or repeated."""
    base, other = prose(1, 300), prose(2, 120)
    texts = [
        (1, base), (2, base), (3, edited(base, 5, 6)), (4, edited(base, 6, 40)), (5, None), (6, ""), (7, " \t\n"),
        (8, "one"), (9, "One"), (10, "two words"), (11, "1234 5678 !!"), (12, other), (12, other), (13, other + " " + base),
        (14, prose(3, 60_000)), (15, "\U0001f600 é é 日本語 <|endoftext|> it's"), (None, base), (None, None),
        (16, "x" * 5000), (17, "A B C D E"), (18, "a b c d e"), (19, (base + "\n") * 3),
    ]
    langs = ["en", None, "de", ""]
    return [(d, t, langs[i % 4], "s", len(t) if t is not None else None, "k", "c", "x", "y", "r") for i, (d, t) in enumerate(texts)]


def edge_documents(spark):
    return spark.createDataFrame(edge_rows(), KINDS)


def no_documents(spark):
    return spark.createDataFrame([], KINDS)


def groups(ids, links):
    """The smallest id that links reach from each id."""
    root = {x: x for x in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {x: top(x) for x in ids}


def near_groups(texts, similarity=75):
    sets = {d: shingles(t) for d, t in texts.items()}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])
    ]
    return sets, groups(sets, links)
