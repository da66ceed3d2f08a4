import random
import re

import pytest

from hourgrid.llm import jaccard_join
from hourgrid.llm.components import connected_components
from hourgrid.llm.frames import table
from tests.llm.helpers import awkward, empty


def grams(text):
    found = re.findall(r"\w+", (text or "").lower())
    n = min(5, len(found))
    return frozenset(tuple(found[i : i + n]) for i in range(len(found) - n + 1)) if n else frozenset()


def brute(rows):
    sets = [(i, grams(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    linked = [0] * len(sets)
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and both >= 0.8 * (len(sets[a][1]) + len(sets[b][1]) - both) - 1e-9:
                linked[a] += 1
                linked[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, least[find(k)], linked[k]) for k, (i, _) in enumerate(sets))


def found(df):
    return sorted((r["doc_id"], r["class_id"], r["n_linked_docs"]) for r in df.collect())


@pytest.fixture
def near_copies():
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for k in range(60):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9999)}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, " ".join(f"u{rng.randrange(900)}" for _ in range(80))) for k in range(40)]
    return rows + [(200 + k, rows[0][1]) for k in range(30)]


@pytest.mark.parametrize("block", [1024, 7])
def test_links_equal_brute_force(spark, near_copies, block):
    docs = spark.createDataFrame(near_copies, "doc_id long, text string")
    assert found(jaccard_join.similar_groups(docs, block=block)) == brute(near_copies)


def test_given_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    rows = [(r[0], r[1]) for r in docs.collect()]
    assert found(jaccard_join.similar_groups(docs)) == brute(rows)


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    groups = jaccard_join.similar_groups(docs).collect()
    assert len(groups) == docs.count()
    by_id = {r["doc_id"]: r for r in groups}
    assert by_id[3]["class_id"] == 3 and by_id[4]["class_id"] == 4 and by_id[4]["n_linked_docs"] == 0
    assert by_id[2]["class_id"] == 1 and by_id[2]["n_links"] == 0 and by_id[2]["n_linked_docs"] == 2
    kept = jaccard_join.drop_similar(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert jaccard_join.similar_groups(empty(spark)).count() == 0


def test_band_counts_reach_the_recall():
    for recall in (0.9, 0.99, 0.999):
        bands, rows = jaccard_join.choose_bands(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** bands >= recall and bands * rows <= jaccard_join.HASHES


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 301), (301, 300)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and all(got[k] == 100 for k in range(100, 160)) and got[301] == 300


def test_ids_of_any_type(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [("b", text), ("a", text), ("c", text + " more"), ("d", "something else that is not alike at all"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = {r["doc_id"]: r["class_id"] for r in jaccard_join.similar_groups(docs).collect()}
    assert found == {"a": "a", "b": "a", "c": "a", "d": "d", None: None}
    assert sorted(r["doc_id"] for r in jaccard_join.drop_similar(docs).collect() if r["doc_id"]) == ["a", "d"]
