import random

import numpy as np
import pytest

from orbweave.llm import decontaminate as dc


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(800)] + ["the", "of", "and"] * 60
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [text(30) for _ in range(12)] + [["tiny", "item"]]
    docs, want = [], set()
    for i in range(240):
        body = text(120)
        if i % 4 == 0:
            k = rng.randrange(12)
            copy = list(items[k])
            for at in rng.sample(range(30), i % 5):  # up to four edits
                copy[at] = "edited"
            if i % 8 == 0:
                del copy[rng.randrange(30)]
            body[40:40] = copy
            want.add((i, k))
        docs.append((i, " ".join(body)))
    docs.append((900, "a Tiny\nITEM here"))
    want.add((900, 12))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(k, " ".join(t).title()) for k, t in enumerate(items)], "item_id long, text string"), want


def pairs(df):
    return {(r["doc_id"], r["item_id"]) for r in df.collect()}


def test_copies_and_edited_copies(corpus):
    docs, items, want = corpus
    assert pairs(dc.contaminated(docs, items)) == want
    assert pairs(dc.contaminated(docs, items, item_bytes=300)) == want  # several blocks of items
    kept = {r["doc_id"] for r in dc.drop_contaminated(docs, items, item_bytes=300).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {d for d, _ in want}


def test_equals_alignment_of_all_pairs(corpus):
    docs, items, _ = corpus
    texts, tests = ([(r[0], r[1].lower().split()) for r in x.collect()] for x in (docs.where("doc_id < 60"), items))
    want = {(i, k) for i, t in texts for k, w in tests if slow(w, t) >= dc.MIN_SCORE * dc.MATCH * len(w)}
    assert pairs(dc.contaminated(docs.where("doc_id < 60"), items)) == want


def test_edits_at_even_distances_equal_alignment_of_all_pairs(spark):
    rng = random.Random(9)
    common = ["the", "of", "and", "a"]
    text = lambda n: [rng.choice(common) if rng.random() < 0.3 else f"w{rng.randrange(500)}" for _ in range(n)]
    items = [text(n) for n in (15, 20, 30, 59) for _ in range(3)]
    docs = []
    for k, item in enumerate(items):
        for step in (2, 3, 4, 5, 6):
            for how in ("replaced", "inserted", "left out"):
                copy = []
                for at, w in enumerate(item):
                    edit = at % step == step - 1
                    copy += [f"x{at}"] if edit and how == "replaced" else [w, f"x{at}"] if edit and how == "inserted" else [] if edit else [w]
                docs.append(text(50) + copy + text(50))
        docs.append(text(30) + [y for w in item for y in (w, "between")])  # no two words of the item are left together
        docs.append(text(30) + item)  # an exact copy elsewhere
        docs.append([w if rng.random() < 0.75 else "edited" for w in item])
    want = {(i, k) for i, t in enumerate(docs) for k, w in enumerate(items) if slow(w, t) >= dc.MIN_SCORE * dc.MATCH * len(w)}
    frames = (spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(x)], f"{c} long, text string") for x, c in ((docs, "doc_id"), (items, "item_id")))
    assert len(want) > 100 and pairs(dc.contaminated(*frames)) == want


def test_long_quotations(spark):
    rng = random.Random(6)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    items = [text(59), text(300), text(300)]
    docs = [text(40) + items[0][20:49] + text(40), text(40) + items[1][100:240] + text(40), text(40) + items[2][5:30] + text(9), text(40) + items[2][5:29] + text(9),
            text(9) + [w for i, w in enumerate(items[1][:60]) if i % 6] + text(9)]
    frames = [spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(x)], f"{c} long, text string") for x, c in ((docs, "doc_id"), (items, "item_id"))]
    assert pairs(dc.contaminated(*frames)) == {(0, 0), (1, 1), (2, 2), (4, 1)}
    assert pairs(dc.contaminated(*frames, quoted=100)) == {(1, 1)}
    assert {r["doc_id"] for r in dc.drop_contaminated(*frames).collect()} == {3}


def slow(a, b):
    row, best = [0] * (len(b) + 1), 0
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (dc.MATCH if x == y else -1), row[j + 1] - 1, new[j] - 1))
        row, best = new, max(best, *new)
    return best


def test_alignment_equals_the_table():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = (rng.integers(0, 4, rng.integers(1, 12)).astype(np.uint64) for _ in range(2))
        assert dc.align(a, b)[0] == slow(a.tolist(), b.tolist())


def test_odd_rows(spark, odd_docs, no_docs, corpus):
    _, items, _ = corpus
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "same words in this one here"), (3, "same words in this one here"), (3, "same words in this one here")], "item_id long, text string")
    got = sorted(map(str, ((r["doc_id"], r["item_id"]) for r in dc.contaminated(odd_docs, odd).collect())))
    assert got == sorted(map(str, [(6, None), (6, 3), (7, None), (7, 3)]))
    assert dc.contaminated(odd_docs, items.limit(0)).count() == 0 and dc.contaminated(no_docs, odd).count() == 0
    kept = dc.drop_contaminated(odd_docs, odd)
    assert kept.schema == odd_docs.schema and kept.count() == odd_docs.count() - 2
    assert dc.drop_contaminated(odd_docs, odd.limit(0)).count() == odd_docs.count()
