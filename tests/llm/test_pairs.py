"""Operators on pairs against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from kinlink.llm import chunking, line_dedup, ngram_join, topk
from kinlink.llm.components import connected_components

SF = "/root/testdata/sf0.01"


def classes(pairs, nodes):
    above = {x: x for x in nodes}

    def find(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        above[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (6000, 6001), (6001, 6000)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = classes([e for e in edges if e[0] != e[1]], {x for e in edges for x in e})
    assert got == {k: v for k, v in want.items() if k != 5000}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_without_the_last_task(spark, monkeypatch):
    monkeypatch.setattr("kinlink.llm.components.FEW_EDGES", 0)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == classes(edges, {x for e in edges for x in e})


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute_documents(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return {(i, len(sets[i]), c) for i, c in classes(links, ids).items()}


def test_similar_documents_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {tuple(r) for r in ngram_join.similar_documents(docs).collect()}
    assert got == brute_documents([(r.doc_id, r.text) for r in docs.collect()])


def test_similar_documents_near_the_limit_and_in_large_groups(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        own = list(base)
        for _ in range(rng.randrange(4)):
            own[rng.randrange(60)] = f"v{rng.randrange(9)}"
        rows.append((i, " ".join(own)))
    rows += [(200 + i, " ".join(f"u{rng.randrange(30)}" for _ in range(rng.randrange(1, 12)))) for i in range(40)]
    got = {tuple(r) for r in ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_documents(rows)


def test_texts_that_share_an_id(spark):
    """Each text of an id has its own links, which the id's other texts share; equal rows change nothing."""
    rng = random.Random(12)
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    near = lambda t: t.rsplit(" ", 1)[0] + " other"
    rows = [(1, text(1)), (5, near(text(1))), (5, text(2)), (5, text(2)), (9, near(text(2))), (7, text(3)), (7, text(4)), (6, near(text(4))), (8, text(5)), (8, None),
            (11, text(6)), (10, text(6)), (11, text(7)), (12, near(text(7)))]
    for _ in range(3):
        rng.shuffle(rows)
        got = {(r.doc_id, r.component_id) for r in ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
        assert got == {(1, 1), (5, 1), (9, 1), (7, 6), (6, 6), (8, 8), (11, 10), (10, 10), (12, 10)}


def test_divide_skip_against_counting():
    rng = random.Random(7)
    for _ in range(300):
        lists = [sorted(rng.sample(range(20), rng.randrange(1, 15))) for _ in range(rng.randrange(1, 14))]
        least = rng.randrange(1, len(lists) + 1)
        count = {d: sum(d in x for x in lists) for d in range(20)}
        assert dict(ngram_join.divide_skip(lists, least)) == {d: n for d, n in count.items() if n >= least}


def test_similar_documents_awkward(awkward, nothing):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.similar_documents(awkward).collect()), key=str)
    by_id = {i: (n, c) for i, n, c in got}
    assert len(got) == awkward.count() and by_id[1] == (0, 1) and by_id[2] == (0, 2) and by_id[3] == (0, 3)
    assert by_id[5][1] == 4 and by_id[6][1] == 6 and by_id[None][1] is None and by_id[9] == (1, 9)
    assert ngram_join.similar_documents(nothing).count() == 0
    kept = ngram_join.keep_one_of_each(awkward)
    assert kept.columns == awkward.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 6, None, 7, 8, 9}


def test_lines_of_the_table_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 250")  # a small fixture for the quadratic check
    rows = [(r.doc_id, n, x) for r in docs.collect() for n, x in enumerate(r.text.split("\n")) if len(x.strip(" ")) >= line_dedup.MIN_CHARS]
    texts = sorted({x for *_, x in rows})
    sets = {x: line_dedup.shingles(x) for x in texts}
    links = [(a, b) for n, a in enumerate(texts) for b in texts[n + 1:]
             if 0.7 < len(sets[a]) / len(sets[b]) < 1.43 and line_dedup.near(sets[a], sets[b])]
    own = classes(links, texts)
    first, size = {}, {}
    for d, n, x in rows:
        first[own[x]] = min(first.get(own[x], (d, n)), (d, n))
        size[own[x]] = size.get(own[x], 0) + 1
    want = {(d, n, *first[own[x]], (d, n) == first[own[x]]) for d, n, x in rows if size[own[x]] > 1}
    got = {tuple(r) for r in line_dedup.line_classes(docs).collect()}
    assert len(got ^ want) <= 0.01 * len(want), (len(got), len(want))


def test_lines_in_large_groups(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 8)
    rng = random.Random(11)
    base = "".join(rng.choice("abcdefghij ") for _ in range(300))
    rows = []
    for i in range(80):
        own = list(base)
        for _ in range(rng.randrange(6)):
            own[rng.randrange(300)] = rng.choice("xyz")
        rows.append((i, "".join(own)))
    got = {r.doc_id: r.keeper_doc_id for r in line_dedup.line_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: line_dedup.shingles(x) for i, x in rows}
    want = classes([(a, b) for a in sets for b in sets if a < b and line_dedup.near(sets[a], sets[b])], sets)
    assert sum(got.get(i, i) != c for i, c in want.items()) <= 1


def test_short_lines_take_part(spark):
    rows = [(1, "Share\n}\nHome | About us\n \t"), (2, "}\nHome | About us\nShare\n"), (3, "Share \nown words\n\t \n日本"), (4, "日本\nHome > About us")]
    got = {(r.doc_id, r.line_no): (r.keeper_doc_id, r.keeper_line_no, r.kept) for r in line_dedup.line_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    first = {(1, 0), (1, 1), (1, 2), (3, 3)}
    copy = {(2, 2): (1, 0), (2, 0): (1, 1), (2, 1): (1, 2), (4, 0): (3, 3)}
    assert got == {place: (*copy.get(place, place), place in first) for place in (*first, *copy)}


def test_lines_of_texts_that_share_an_id(spark):
    """Only the line that stands elsewhere goes, from the text it stands in."""
    rows = [(1, "B\nalpha line of words"), (2, "B\nbeta line of words"), (2, "unique\nsecond line here"), (2, "unique\nsecond line here"), (3, "third\nunique")]
    got = sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, "B\nalpha line of words"), (2, "beta line of words"), (2, "unique\nsecond line here"), (2, "unique\nsecond line here"), (3, "third")]


def test_lines_awkward(awkward, nothing):
    kept = line_dedup.dedup_lines(awkward)
    rows = {r.doc_id: r.text for r in kept.collect()}
    assert kept.columns == awkward.columns and 5 not in rows and 8 not in rows and rows[None] and rows[2] == "" and rows[1] is None
    assert line_dedup.line_classes(nothing).count() == 0 and line_dedup.dedup_lines(nothing).count() == 0


def test_top_k_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 6)).astype("float32")
    x[300:400] = x[300]
    rows = [(i, [float(v) for v in x[i]]) for i in range(700)] + [(700, None), (701, [1.0, None]), (702, [float("nan")] * 6), (None, [1.0] * 6), (5, [float(v) for v in x[5]])]
    got = {tuple(r) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.expr("vec_id % 10 = 0"), 7, block=128).collect()}
    m = np.floor(x.astype(float) * 1024)
    want = set()
    for q in range(0, 700, 10):
        score = m @ m[q]
        order = [i for i in np.lexsort((np.arange(700), -score)) if i != q][:7]
        want |= {(q, n + 1, int(i), int(score[i])) for n, i in enumerate(order)}
    assert got == want
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (10, [1e300])], "vec_id long, embedding array<double>")
    assert topk.top_k(few, F.expr("vec_id % 10 = 0"), 5).count() == 4
    assert topk.top_k(few.where("false"), F.lit(True), 5).count() == 0


def plain_top(m, asking, k):
    want = set()
    for q in asking:
        score = m @ m[q]
        order = [i for i in np.lexsort((np.arange(len(m)), -score)) if i != q][:k]
        want |= {(q, n + 1, int(i), int(score[i])) for n, i in enumerate(order)}
    return want


def clustered(clusters, each, width, seed=4):
    rng = np.random.default_rng(seed)
    return np.floor((rng.normal(size=(clusters, 1, width)) * 3 + rng.normal(size=(clusters, each, width)) * 0.02).reshape(-1, width) * 1024)


def test_cover_tree_covers_its_points_and_keeps_centers_apart():
    rng = np.random.default_rng(6)
    for x in (clustered(30, 20, 8), np.floor(rng.normal(size=(500, 64)) * 1024), np.zeros((40, 3)), np.zeros((5, 0))):
        tree = topk.cover_tree(x)
        assert sorted(np.concatenate([node.singles for node in tree.nodes()]).tolist()) == list(range(len(x)))
        for node in tree.nodes():
            assert np.sqrt(((x[node.points] - node.center) ** 2).sum(1)).max() <= node.radius + 1e-6
            assert sorted(np.concatenate([node.singles, *(c.points for c in node.children)]).tolist()) == sorted(node.points.tolist())
            if node.children:
                centers = np.array([c.center for c in node.children] + [x[i] for i in node.singles])
                away = np.sqrt(topk._square_distances(centers, centers)) + np.eye(len(centers)) * 1e18
                assert away.min() > node.radius / 2 - 1e-6 and all(c.radius <= node.radius / 2 + 1e-6 for c in node.children)
        assert len(list(tree.nodes())) > 1 or len(x) <= topk.LEAF or tree.radius == 0 or len(tree.singles) == len(x)


def test_dual_search_leaves_pairs_of_nodes_out():
    x, tally = clustered(40, 50, 12), {}
    asking = np.arange(0, len(x), 20)
    found = topk.dual_search(x[asking], x, asking, np.arange(len(x)), 10, tally=tally)
    assert {(q, i, s) for q, i, s in found} == {(q, i, s) for q, _, i, s in plain_top(x, asking.tolist(), 10)}
    assert tally["pruned"] > 0 and tally["scored"] < 0.2 * len(asking) * len(x)


def test_top_k_rules_out_centers_before_the_shuffle(spark):
    x, tally = clustered(24, 60, 10, seed=8), {}
    rows = [(i, (v / 1024).tolist()) for i, v in enumerate(x)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.expr("vec_id % 20 = 0"), 10, block=64, tally=tally)
    assert {tuple(r) for r in got.collect()} == plain_top(x, range(0, len(x), 20), 10)
    assert 0 < tally["reached"] < 0.5 * tally["possible"]


def test_top_k_of_huge_short_and_equal_vectors_over_several_centers(spark):
    rng = np.random.default_rng(9)
    lists = [[float(v) for v in rng.normal(size=rng.integers(0, 5)) * 10.0 ** rng.integers(0, 16)] for _ in range(150)] + [[1.0, 2.0]] * 50
    got = topk.top_k(spark.createDataFrame(list(enumerate(lists)), "vec_id long, embedding array<double>"), F.expr("vec_id % 10 = 0"), 4, block=16)
    ints = [[int(np.clip(np.floor(v * 1024), -2.0**63, 2**63 - 1)) for v in x] for x in lists]
    dot = lambda a, b: max(-2**63, min(2**63 - 1, sum(p * q for p, q in zip(a, b))))
    want = {(q, n + 1, i, -s) for q in range(0, 200, 10) for n, (s, i) in enumerate(sorted((-dot(ints[q], ints[i]), i) for i in range(200) if i != q)[:4])}
    assert {tuple(r) for r in got.collect()} == want


def test_chunks_cover_texts_and_resist_shifts(spark):
    rng = np.random.default_rng(2)
    passage = "".join(chr(97 + c) for c in rng.integers(0, 26, 600))
    for text in ("", "é" * 3000, passage, "a" * 5000, "日本" * 700):
        data = np.frombuffer(text.encode(), np.uint8)
        cuts = chunking.cut_points(data).tolist()
        assert (cuts[-1] if cuts else 0) == len(data) and cuts == sorted(set(cuts)) and max(np.diff([0, *cuts]), default=0) <= chunking.MAX_BYTES
        for a, b in zip([0, *cuts], cuts):
            data[a:b].tobytes().decode()
    rows = [(1, "q" * 37 + passage + "ü"), (2, "other words " + passage), (3, "nothing of the kind " * 2)]
    got = chunking.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.doc_id for r in got if r.first_doc_ids == [1]] == [2] and sum(r.bytes for r in got if r.doc_id == 2) > 450


def test_chunks_by_plain_counting(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen, want = {}, set()
    for d, text in sorted((r.doc_id, r.text) for r in docs.collect()):
        data, start = text.encode(), 0
        for end in chunking.cut_points(np.frombuffer(data, np.uint8)).tolist():
            place = (d, len(data[:start].decode()))
            if end - start >= chunking.REACH and seen.setdefault(data[start:end], place) != place:
                want.add((*place, *seen[data[start:end]]))
            start = end
    got = {(r.doc_id, r.start, r.first_doc_id, r.first_start) for r in chunking.repeated_chunks(docs).collect()}
    assert got == want


def test_chunks_awkward(awkward, nothing):
    assert {r.doc_id for r in chunking.repeated_spans(awkward).collect()} >= {5}
    assert chunking.repeated_spans(nothing).count() == 0


@pytest.mark.parametrize("n", [1, 5, 10, 57, 300])
def test_prefixes_share_enough(n):
    rng = random.Random(n)
    for _ in range(200):
        x = set(rng.sample(range(10 * n), n))
        y = set(x)
        for t in rng.sample(sorted(x), min(n, n // 9)):
            y.discard(t)
        y |= {10 * n + i for i in range(n // 20)}
        if 100 * len(x & y) < 80 * len(x | y):
            continue
        order = lambda s: sorted(s, key=lambda t: hash((t, "o")))
        px, py = (set(order(s)[:ngram_join.prefix_length(len(s))]) for s in (x, y))
        assert len(px & py) >= max(1, ngram_join.required(len(x)) // 10)


def test_pairs_of_lines_at_and_about_the_limit():
    rng = random.Random(5)
    lines = ["".join(rng.choice("abc é漢") for _ in range(rng.choice([8, 9, 40, 300]))) for _ in range(150)]
    x = [line for line in lines for _ in range(8)] + ["z" * 200_000, "abcdefgh" * 40_000]
    y = [line[:cut] + "#" * extra + line[cut + extra:] for line in lines
         for cut, extra in ((0, 0), (len(line), 3), (len(line) // 2, 1), (len(line) // 3, 2), (1, 1), (len(line), 1), (len(line), 10), (len(line), 75))]
    y += ["z" * 200_000, "abcdefgh" * 39_000 + "y"]
    expect = [line_dedup.near(line_dedup.shingles(a), line_dedup.shingles(b)) for a, b in zip(x, y)]
    got = line_dedup.near_pairs(pa.array(x), pa.array(y)).tolist()
    assert got == expect and 0 < sum(expect) < len(expect)
    assert len(line_dedup.near_pairs(pa.array([], pa.string()), pa.array([], pa.string()))) == 0


def test_small_and_large_cells_give_links_of_one_kind():
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(90)) for _ in range(12)]
    rows = [(i, i, base[i % 12] + "!" * (i // 12)) for i in range(36)]
    batch = lambda cells: pa.RecordBatch.from_pylist(
        [{"cell": c, "query": kind, "id": i, "label": label, "line": line} for c, q, ix in cells for kind, side in ((0, ix), (1, q)) for i, label, line in side])
    few = [(c, [row], rows[c % 12::12]) for c, row in enumerate(rows)]
    links = {n: list(line_dedup._cells(iter([batch(x)]))) for n, x in (("small", few), ("large", [(0, rows, rows)]))}
    linked = {n: {frozenset(p) for b in x for p in zip(*(c.to_pylist() for c in b.columns))} for n, x in links.items()}
    assert linked["large"] <= linked["small"] and len(linked["large"]) == 24
    assert all(a % 12 == b % 12 for a, b in map(tuple, linked["small"]))
    assert [b.num_rows for b in line_dedup._cells(iter([]))] == [0]


def test_hubs_and_members_of_buckets(spark):
    """Packed rows give every bucket's ids their smallest one, from one task and from several, hot buckets included."""
    from kinlink.llm import buckets as B, kernels as K
    rng = random.Random(3)
    rows = [(rng.choice([-7, 5, 1 << 62, rng.randrange(-300, 300)]), rng.randrange(-400, 400)) for _ in range(4000)]
    keys = lambda batch: (batch.column(0).to_numpy(), batch.column(1).to_numpy())
    held = {}
    for bucket, own in rows:
        held.setdefault(bucket, set()).add(own)
    for tasks in (1, 5):
        table = spark.createDataFrame(rows, "bucket bigint, id bigint").repartition(tasks)
        got = [tuple(r) for r in B.star_pairs(table, keys).collect()]
        near = {}
        for bucket, hub, member in got:
            assert hub < member
            near.setdefault(bucket, {}).setdefault(member, set()).add(hub)
        for bucket, ids in held.items():
            least = min(ids)
            found = near.get(bucket, {})
            assert set(found) | {least} == ids
            assert all(h == least or least in found[h] for hubs in found.values() for h in hubs)
    assert B.star_pairs(spark.createDataFrame([], "bucket bigint, id bigint"), keys).count() == 0
    ids = np.arange(50_000)
    sent = B._local(K.mix(ids.astype(K.U)).view(np.int64), ids)
    assert sum(len(x) for x in sent.column(1).to_pylist()) == 16 * len(ids) and sent.num_rows <= B.PARTS


def test_shuffles_of_written_tables_are_deleted(spark):
    import os
    import time

    from kinlink.llm import store
    from kinlink.sources import scratch

    def shuffled():
        dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {f for d in dirs for at, _, files in os.walk(d.getPath()) for f in files if f.startswith("shuffle_")}

    for written in (store.written, scratch.written):
        before = shuffled()
        rows = written(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "kept")
        for _ in range(100):
            if not (left := shuffled() - before):
                break
            time.sleep(0.1)
        assert not left and rows.count() == 7
    assert spark.conf.get(scratch.CLEANUP) == "false"
