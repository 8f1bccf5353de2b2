import pytest
from cases import TRICKY


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) rows: tricky texts, exact and near copies, shared passages, a long text."""
    import random

    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdeéilnorstu") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = sentence(60)
    texts = list(TRICKY)
    for i in range(30):
        texts.append(sentence(rng.randint(5, 120)))
    base = sentence(150)
    for i in range(12):
        w = base.split(" ")
        for _ in range(i):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(" ".join(w))
    texts += [base, base, texts[20], texts[21].upper()]
    texts += [sentence(20) + " " + passage + " " + sentence(15), sentence(3) + "\n" + passage, passage, passage + " " + passage]
    texts.append(sentence(6000))
    return [(i, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    rows = [(i, t, "en" if i % 3 else None, 7) for i, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, rid int").repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, rid int")
