import hashlib
import re
from collections import Counter

from hourgrid.llm import exact_dedup
from hourgrid.llm.frames import table
from tests.llm.helpers import awkward, empty


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = Counter(normal(t) for _, t in rows)
    keep = {}
    for i, t in rows:
        if i is not None:
            keep[normal(t)] = min(i, keep.get(normal(t), i))
    return sorted(
        (i or -1, keep.get(normal(t)), groups[normal(t)], hashlib.sha256(normal(t).encode()).hexdigest()) for i, t in rows
    )


def found(df):
    return sorted((r["doc_id"] or -1, r["keep_id"], r["group_size"], r["text_sha256"]) for r in df.collect())


def test_groups_equal_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    rows = [(r[0], r[1]) for r in docs.collect()]
    groups = exact_dedup.exact_groups(docs, bucket_keys=10)
    assert found(groups) == expected(rows)
    assert groups.where("kept").count() == len({normal(t) for _, t in rows})


def test_awkward_rows(spark):
    docs = awkward(spark)
    groups = exact_dedup.exact_groups(docs).collect()
    assert len(groups) == docs.count()
    kept = [r for r in groups if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in groups})
    assert {r["keep_id"] for r in groups if r["doc_id"] in (3, 4)} == {3}  # NULL is the empty text
    assert sum(r["kept"] for r in groups if r["doc_id"] == 2) == 0
    kept_rows = exact_dedup.drop_exact_copies(docs)
    assert kept_rows.columns == docs.columns and kept_rows.count() == len(kept)


def test_repeated_keeper_stays_once(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a  b"), (1, "a b"), (2, "a b")], "doc_id long, text string")
    assert [r["kept"] for r in exact_dedup.exact_groups(docs).collect()].count(True) == 1
    assert exact_dedup.drop_exact_copies(docs).count() == 1


def test_empty_table(spark):
    assert exact_dedup.exact_groups(empty(spark)).count() == 0
    assert exact_dedup.drop_exact_copies(empty(spark)).count() == 0


def test_directory_splits_only_full_buckets(spark):
    keys = spark.range(2000).selectExpr("xxhash64(id) AS key")
    slots, bits = exact_dedup.directory(keys, 2000, bucket_keys=100)
    rows = slots.collect()
    assert sorted(r["slot"] for r in rows) == list(range(2**bits))
    assert all(r["bucket_keys"] <= 100 for r in rows)
    buckets = {r["bucket"]: r["bucket_keys"] for r in rows}
    assert sum(buckets.values()) == 2000
    # A slot belongs to the bucket that starts at its leading bits.
    assert all(r["bucket"] == (r["slot"] >> (bits - r["depth"])) << (bits - r["depth"]) for r in rows)


def test_colliding_keys_are_chained_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: exact_dedup.F.lit(7).cast("long"))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")
    rows, index = exact_dedup.build_index(docs)
    assert sorted((r["keep_id"], r["chain"], r["group_size"]) for r in index.collect()) == [(1, 1, 2), (2, 2, 1)]
