from collections import Counter

import numpy as np

from meterline.llm import near_duplicates as N
from meterline.llm.components import components
from tests.llm.brute import near_classes


def as_rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def check(df):
    rows = as_rows(df)
    want = Counter((rows[i][0], *x) for i, x in near_classes(rows).items())
    got = Counter((r["doc_id"], r["class_id"], r["links"]) for r in N.classes(df).collect())
    assert got == want
    return rows, want


def test_all_links_of_all_documents(documents):
    _, want = check(documents)
    assert sum(n for (_, _, links), n in want.items() if links) > 50


def near_copies(rng, base, n, edits, first):
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.integers(0, len(base), edits):
            words[at] = f"x{rng.integers(0, 10**6)}"
        rows.append((first + i, " ".join(words)))
    return rows


def test_large_group_of_near_copies(spark, monkeypatch):
    """Near copies that paths can't part: one search settles them, or blocks do where they are too many for one."""
    rng = np.random.default_rng(1)
    rows = near_copies(rng, [f"w{k}" for k in rng.integers(0, 5000, 400)], 300, 3, 0)
    rows += [(1000 + i, " ".join(f"u{k}" for k in rng.integers(0, 10**6, 100))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df)
    monkeypatch.setattr(N, "BLOCK_NODES", 100)
    monkeypatch.setattr(N, "SEARCHED", 90)
    monkeypatch.setattr(N, "SEARCH_NODES", 120)
    check(df)


def test_bucket_of_two_groups_and_others(spark, monkeypatch):
    """Two large groups, and chains that end outside of a group, share the path of one long passage."""
    rng = np.random.default_rng(5)
    passage = [f"p{k}" for k in range(300)]
    rows = near_copies(rng, passage + [f"a{k}" for k in range(60)], 150, 2, 0)
    rows += near_copies(rng, passage + [f"b{k}" for k in range(60)], 100, 2, 1000)
    rows += [(2000 + i, " ".join(passage + [f"c{k}" for k in range(4 * i, 4 * i + 90)])) for i in range(40)]
    monkeypatch.setattr(N, "BLOCK_NODES", 70)
    monkeypatch.setattr(N, "SEARCHED", 30)
    monkeypatch.setattr(N, "SEARCH_NODES", 40)
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_a_leading_group_is_sent_once(spark, monkeypatch):
    """Rows to compare grow with the group, not with its square."""
    monkeypatch.setattr(N, "SEARCH_NODES", 50)
    rng = np.random.default_rng(2)
    other = rng.integers(0, 256, (10, N.SKETCH), dtype=np.uint8)
    for n in (500, 2000):
        group = np.repeat(rng.integers(0, 256, (1, N.SKETCH), dtype=np.uint8), n, axis=0)
        rows = [(7, str(i).encode(), m.tobytes()) for i, m in enumerate(np.concatenate((group, other)))]
        links, blocks = N.leading_groups(spark.createDataFrame(rows, "path long, node binary, sketch binary"))
        assert links.count() == n and blocks.count() == n + 10 * (n // 50 + 1)


def test_sketches_alike():
    rng = np.random.default_rng(3)
    marks = rng.integers(0, 3, (500, N.SKETCH), dtype=np.uint8)
    marks[:50] = marks[0]
    want = (marks == marks[0]).sum(axis=1) >= N.LOOSE * N.SKETCH
    assert (N.alike(marks, marks[0]) == want).all() and want.sum() >= 50 and not want.all()


def test_odd_rows(odd_docs, no_docs, clashing):
    check(odd_docs)
    assert N.classes(no_docs).count() == 0
    assert N.classes(clashing).count() == odd_docs.count()
    kept = N.first_of_class(clashing)
    assert kept.columns == clashing.columns
    # one row of empties, one long, one of the three equal texts, one of two words, one of marks, one large id
    assert kept.count() == 6 and 2**60 + 1 in {r["doc_id"] for r in kept.collect()}
    assert N.first_of_class(no_docs).count() == 0


def test_one_of_each_class_stays(documents):
    want = near_classes(as_rows(documents))
    kept = {r["doc_id"] for r in N.first_of_class(documents).select("doc_id").collect()}
    assert kept == {c for c, _ in want.values()}


def test_runs_reach_the_target_recall():
    rng = np.random.default_rng(0)
    shared = rng.integers(0, 2**63, 80).astype(np.uint64)
    a = np.unique(np.concatenate((shared, rng.integers(0, 2**63, 10).astype(np.uint64))))
    b = np.unique(np.concatenate((shared, rng.integers(0, 2**63, 10).astype(np.uint64))))
    met = 0
    for trial in range(400):
        pa = pb = np.array([trial + 1], np.uint64)
        for _ in range(N.DEPTH):
            pa = N.chosen(a, pa, 0.8)[1] if len(pa) else pa
            pb = N.chosen(b, pb, 0.8)[1] if len(pb) else pb
        met += bool(set(pa.tolist()) & set(pb.tolist()))
    assert 1 - (1 - met / 400) ** N.runs_needed() > 0.995


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)] + [(200, 200), (None, 3)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a int, b int")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in range(100, 180)} == {100}
    assert 200 not in got
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0
