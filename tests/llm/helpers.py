"""Small tables with awkward rows, and plain versions of what the operators compute."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, changes):
    w = text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def awkward_docs():
    """Nulls in every column, empty and blank texts, one very long text, equal texts, repeated rows, short texts."""
    rng = random.Random(5)
    base = prose(rng, 60)
    texts = [base, base, edited(rng, base, 1), None, "", " \t\n", "one two", "one two", "Ünï cödé 漢字 " * 3, prose(rng, 30_000), prose(rng, 40)]
    out = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(texts)]
    return [*out, out[0], out[0], (None, prose(rng, 20), None, None, None), (None, base, None, None, None), (50, None, None, None, None)]


class Find:
    def __init__(self):
        self.up = {}

    def __call__(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self(a), self(b)))
        self.up[b] = a
