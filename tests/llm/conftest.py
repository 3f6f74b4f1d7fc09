import random

import pytest

#: Columns whose names the operators use themselves.
CLASHING = {"h": "x", "n": 7, "token": "t", "key": "k", "spans": "s", "rank": 3, "length": 9, "part": "p", "row": 1, "removed": "r"}


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, clashing=True):
        """rows: (doc_id, text) or (doc_id, text, lang, source)."""
        full = []
        for r in rows:
            r = (*r, *("en", "s0")[len(r) - 2:]) if len(r) < 4 else r
            full.append((*r, len(r[1]) if r[1] is not None else None, *(CLASHING.values() if clashing else ())))
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        if clashing:
            schema += ", " + ", ".join(f"{k} {'string' if isinstance(v, str) else 'int'}" for k, v in CLASHING.items())
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Odd and planted texts: copies, near copies, shared passages, nulls, a very long
    text, a repeated row, ties, mixed white space."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 5))) for _ in range(300)]

    def text(n):
        return " ".join(rng.choices(vocabulary, k=n))

    passage = text(70)
    rows = [(i, text(rng.randint(3, 160))) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(5)]
    for i in range(20):
        words = rows[7][1].split() if i < 10 else rows[9][1].split()
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((200 + i, " ".join(words)))
    rows += [(300 + i, f"{text(20)}\n{passage}  {text(15)}") for i in range(8)]
    rows += [(400, None), (401, ""), (402, " \t\n"), (403, "one"), (404, "one TWO"), (405, "One two"), (406, "la " * 300),
             (407, text(6000)), (408, "\tx  y\r\nz "), (None, text(90)), (None, None), (409, "Äpfel Öl ß " * 20)]
    rows += [(500, rows[5][1]), (500, rows[5][1])]
    return rows


def words_of(text, lower=False):
    import re

    text = text or ""
    if lower:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall("[^\x20\x09-\x0d]+", text)
