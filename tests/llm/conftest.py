import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, blk long, key string, row string, _m int, cls long"
WORDS = "the cat sat on a mat and saw one dog run far from home while rain fell over old grey roofs near river bank".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "er"]) for _ in range(n))


def awkward(seed=1, n=60):
    """Ids and texts: random prose with shared passages, copies, near copies, and every odd case."""
    rng = random.Random(seed)
    passage = [sentence(rng, 60) for _ in range(3)]
    base = [sentence(rng, rng.randint(1, 120)) for _ in range(n)]
    rows = []
    for i, text in enumerate(base):
        kind = rng.randrange(6)
        if kind == 0:
            text = text + "\n" + rng.choice(passage) + " " + sentence(rng, 10)
        elif kind == 1:
            words = rng.choice(base).split()
            for _ in range(max(1, len(words) // 40)):
                words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif kind == 2:
            text = rng.choice(base)
        rows.append((i * 7 % 101, text))
    odd = ["", " \t\n ", "one", "Ünïcödé ▁ 🙂 " * 30, "a" * 3000, "ha ha " * 400, "x\ny\nx\ny\n" * 20, "\\ <|im_end|> \x1c\x0b word"]
    rows += [(200 + i, t) for i, t in enumerate(odd)]
    rows += [(300, None), (None, base[0]), (None, None), (301, base[1]), (301, base[1]), (302, sentence(rng, 20000))]
    return rows


@pytest.fixture
def docs(spark):
    """A frame of rows ``(doc_id, text)`` with further columns whose names operators use themselves."""

    def make(rows):
        full = [(i, t, "en", f"src{len(t or '') % 3}", len(t or ""), 5, "k", "r", 1, 2) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make
