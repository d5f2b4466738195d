"""A small corpus with every case that operators must define."""

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


def documents(seed=1):
    rng = random.Random(seed)
    base, other, passage = prose(rng, 120), prose(rng, 90), prose(rng, 40)
    texts = [base, base, base + " tail", other]
    words = base.split()
    for k in range(12):  # near copies on either side of the threshold
        w = list(words)
        for _ in range(k + 1):
            w[rng.randrange(len(w))] = prose(rng, 1)
        texts.append(" ".join(w))
    texts += [f"{prose(rng, 30)} {passage} {prose(rng, 30)}" for _ in range(6)]
    texts += [None, "", " \t\n", "one", "one two three", "One TWO three", "a b c d e", "A b\nc\td e", "x" * 900, "ab" * 400]
    texts += ["\n".join([prose(rng, 12), "Shared line of boilerplate words", prose(rng, 9)]) for _ in range(14)]
    texts += ["naïve façade — ☃ 漢字 \U0001f600 " * 8, "<|endoftext|> plain <|endoftext|>", prose(rng, 6000), "KOPF!! " * 60, "the of and " * 5]
    rows = [(i, t, "en", f"s{i % 13}" if i % 17 else None, len(t or "")) for i, t in enumerate(texts)]
    return rows
