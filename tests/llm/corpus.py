"""Documents for tests: prose, exact and near copies, junk, personal data, licences and edge cases."""

import random

EDGES = [
    (None, "plain words under a null id"), (900, None), (901, ""), (902, " \n\t "), (903, "word"), (904, "   wide spaces \u0085 here"), (905, "日本語のテキスト 😀😀 mixed"),
    (906, "x" * 70_000), (907, "a@b.c%d@e.f 1.2.3.4.5.6.7.8 +1-2-3-4-5-6-7-8-9-0 " * 3), (908, "same text twice"), (908, "same text twice"), (909, "same  text\ntwice"), (910, "<|endoftext|> between <|endoftext|> words"),
]


def prose(rng, n, vocabulary):
    words = [rng.choice(vocabulary) for _ in range(n)]
    out, at = [], 0
    while at < n:
        step = rng.randint(6, 14)
        out.append(" ".join(words[at : at + step]).capitalize() + ".")
        at += step
    return "\n".join(out)


def corpus(seed=0, n=120, edges=True):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    rows = [(k, prose(rng, rng.choice((8, 30, 90, 200, 400)), vocabulary)) for k in range(n)]
    for k in range(n, n + n // 2):
        words = rows[rng.randrange(n)][1].split(" ")
        for _ in range(rng.choice((0, 0, 1, 2, 4, 9))):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((k, " ".join(words)))
    base = prose(rng, 150, vocabulary).split(" ")
    for k in range(n + n // 2, n + n // 2 + 60):
        words = list(base)
        for _ in range(k % 6):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((k, " ".join(words)))
    rng.shuffle(rows)
    return rows + (EDGES if edges else [])


JUNK = ["buy### now$$$ cheap%%% ", "| cell | cell | cell ", "CLICK!! HERE!! NOW!! ", "spam spam spam spam "]
